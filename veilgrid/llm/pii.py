"""Personal data: base patterns, and a semi-Markov conditional random field for the forms they miss.

The base patterns always count. Between their matches, zones that look as if they might hold an e-mail address, an
address of a host, a card or a telephone number in another form (``name [at] host [dot] com``, ``10[.]0[.]0[.]7``,
``(312) 555-0199``, ``4111.1111.1111.1111``), or one that a pattern took together with the figures beside it and then
dropped (a telephone number before an address of a host, a card beside another number), are decoded by the field, whose
spans are added. It is trained here, on generated zones, once for each driver.

Defined results: a null text is the empty text and holds nothing; repeated rows give one row each; a null id stays null;
an empty table gives an empty table; other columns are ignored. Whole texts are searched, in time linear in their
length. Offsets count code points; spans of different kinds may overlap, spans of one kind do not.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import arrow_text
from .semi_markov import LONGEST, OUTSIDE, TOKEN, Segment, SemiMarkov, Token, tokens
from .storage import id_and_text

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match begins where a run of digits does, so looking only there changes no match and keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){11,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches: the run of local characters before an @, and the longest domain after it."""
    floor = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > floor and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            yield "email", begin, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[Span]:
    found = list(emails(text))
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    found += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: list[Span]) -> str:
    return ",".join([f"{kind}:{a}:{b}" for kind, a, b in spans])


# --- zones -----------------------------------------------------------------------------------------------------------
_SUSPECT = re.compile(r"[0-9](?:[0-9]|[ ().\[\]/-]{1,3}(?=[0-9(\[])){6,}+|[\[({<] ?(?:at|AT|dot|DOT) ?[\])}>]|\b(?:at|AT)\b(?= [\w-]{1,40} (?:dot|DOT)\b)|[0-9]\[\.\][0-9]")
#: A zone reaches as many tokens beyond a suspect as a segment may have, so that no candidate crosses its edge; a token's
#: part that lies further than so many characters back is left out.
FURTHEST = 400


def _reach(text: str, begin: int, end: int) -> tuple[int, int]:
    """The place ``LONGEST`` tokens before ``begin`` and after ``end``, or where a gap that no candidate crosses comes first."""
    low = begin
    for k, m in enumerate(TOKEN.finditer(text[max(0, begin - FURTHEST) : begin][::-1])):
        if k == LONGEST or m.start() - (begin - low) > 1:
            break
        low = begin - m.end()
    high = end
    for k, m in enumerate(TOKEN.finditer(text, end)):
        if k == LONGEST or m.start() - high > 1:
            break
        high = m.end()
    return low, high


def zones(text: str, known: list[Span]) -> list[tuple[int, int]]:
    """Stretches around suspects, joined where they overlap and cut at the base spans."""
    raw: list[list[int]] = []
    for m in _SUSPECT.finditer(text):
        a, b = _reach(text, m.start(), m.end())
        if raw and a <= raw[-1][1]:
            raw[-1][1] = max(raw[-1][1], b)
        else:
            raw.append([a, b])
    if not raw:
        return []
    blocked: list[list[int]] = []
    for _, a, b in sorted(known, key=lambda s: s[1]):
        if blocked and a <= blocked[-1][1]:
            blocked[-1][1] = max(blocked[-1][1], b)
        else:
            blocked.append([a, b])
    out, k = [], 0
    for a, b in raw:
        while k < len(blocked) and blocked[k][1] <= a:
            k += 1
        at = k
        while at < len(blocked) and blocked[at][0] < b:
            if a < blocked[at][0]:
                out.append((a, blocked[at][0]))
            a = max(a, blocked[at][1])
            at += 1
        if a < b:
            out.append((a, b))
    return out


# --- features of whole spans -----------------------------------------------------------------------------------------
# Words that announce a kind of number or address.
CUES = {
    "phone": "tel phone telephone call mobile fax cell dial telefon rufnummer handy teléfono móvil llame téléphone appelez portable".split(),
    "card": "card visa mastercard amex credit debit karte kreditkarte tarjeta carte".split(),
    "email": "mail email e contact write correo courriel schreiben".split(),
    "ip": "ip host server address serveur servidor adresse".split(),
}
_CUE = {w: kind for kind, words in CUES.items() for w in words}
_AT, _DOT, _BRACKETS = {"at", "AT"}, {"dot", "DOT"}, set("[({<])}>")


MOST_DIGITS = 19


def _rows(toks: list[Token], digit: list[int]) -> list[bool]:
    """Which figures follow other figures, with nothing but up to three marks or spaces between."""
    out, last = [False] * len(toks), -1
    for k, (word, begin, _) in enumerate(toks):
        if digit[k]:
            out[k] = last >= 0 and begin - toks[last][2] <= 3
            last = k
        elif word[0].isalpha():
            last = -1
    return out


def candidates(toks: list[Token]) -> Iterator[tuple[int, int]]:
    """Spans that begin and end at a word, figures or an opening mark, in order of their beginnings: seven to nineteen digits,
    four groups of figures, or a word with a spelled-out at and dot after it. Figures that stand in a longer row of figures
    are no candidates, unless an opening mark sets them off or they are as long as a card by themselves."""
    n = len(toks)
    digit = [len(t) if t[0].isdigit() else 0 for t, _, _ in toks]
    ats = [t in _AT for t, _, _ in toks]
    dots = [t in _DOT for t, _, _ in toks]
    follows = _rows(toks, digit)
    for i in range(n):
        first = toks[i][0]
        opens = first in ("(", "+")
        if opens:
            if i + 1 >= n or not digit[i + 1]:
                continue
        elif not first[0].isalnum():
            continue
        figures = groups = 0
        has_at = has_dot = False
        one_word = True  # what stands before the spelled-out at
        for j in range(i + 1, min(n, i + LONGEST) + 1):
            k = j - 1
            word, begin, _ = toks[k]
            if k > i:
                gap = begin - toks[k - 1][2]
                if gap > 1:
                    break
                if ats[k]:
                    has_at |= one_word
                elif gap and not has_at and word not in _BRACKETS:
                    one_word = one_word and ats[k]
            figures += digit[k]
            groups += digit[k] > 0
            has_dot |= dots[k] and has_at
            if not has_at and (figures > MOST_DIGITS or not one_word and not digit[i] and not opens):
                break
            if not word[0].isalnum():
                continue
            if has_at:
                if has_dot and word not in _AT | _DOT and first not in _AT | _DOT and not opens:
                    yield i, j
            elif digit[k] and (digit[i] or opens):
                apart = opens or not follows[i] and not _followed(toks, digit, follows, k)
                if (figures >= 7 or figures >= 4 and groups == 4 and not opens) and apart or i == k and figures >= 12:
                    yield i, j


def _followed(toks: list[Token], digit: list[int], follows: list[bool], k: int) -> bool:
    """Whether other figures follow the figures at ``k``."""
    for x in range(k + 1, min(len(toks), k + 4)):
        if digit[x]:
            return follows[x]
        if toks[x][0][0].isalpha():
            return False
    return False


def _bucket(n: int) -> str:
    return str(n) if n <= 20 else "more"


def span_features(toks: list[Token], i: int, j: int) -> list[str]:
    words = [t for t, _, _ in toks[i:j]]
    figures = "".join(w for w in words if w[0].isdigit())
    parts = [len(w) for w in words if w[0].isdigit()]
    letters = any(w[0].isalpha() for w in words)
    marks = "".join(sorted({w for w in words if not w[0].isalnum()}))
    gaps = any(b[1] > a[2] for a, b in zip(toks[i:j], toks[i + 1 : j], strict=False))
    octets = len(parts) == 4 and all(w.isdigit() and int(w) <= 255 for w in words if w[0].isdigit() and len(w) <= 3) and max(parts) <= 3
    before = [t.lower() for t, _, _ in toks[max(0, i - 3) : i]]
    cue = next((_CUE[w] for w in reversed(before) if w in _CUE), "none")
    glued = (i > 0 and toks[i - 1][2] == toks[i][1] and toks[i - 1][0][-1] not in "([:<\"'") or (j < len(toks) and toks[j][1] == toks[j - 1][2] and (toks[j][0][0].isalnum() or toks[j][0][0] in "-/_[(="))
    shape = "-".join(map(str, parts)) if len(parts) <= 5 and len(figures) <= 20 else f"{len(parts)} groups"
    spelled = any(w in _AT for w in words) and any(w in _DOT for w in words)
    return [
        "any", f"letters {letters} spelled {spelled}", f"digits {_bucket(len(figures))} letters {letters}", f"shape {shape} letters {letters}", f"marks {marks[:6]} letters {letters} gaps {gaps}",
        f"luhn {12 <= len(figures) <= 19 and luhn(figures)} letters {letters}", f"octets {octets} marks {marks[:6]}", f"cue {cue}", f"cue {cue} digits {_bucket(len(figures))}", f"glued {glued}", f"first {words[0] if words[0] in '(+' else 'other'} digits {_bucket(len(figures))}",
        f"spelled {spelled} words {min(sum(w[0].isalnum() for w in words), 9)}", f"spelled {spelled} brackets {marks[:6]}", f"one {len(words) == 1}",
    ]


# --- training --------------------------------------------------------------------------------------------------------
def _word(r: random.Random) -> str:
    return "".join(r.choice(("th", "er", "on", "an", "re", "en", "de", "la", "ti", "ung", "el", "que", "st", "or", "a", "o", "i")) for _ in range(r.randint(1, 4)))


def _card(r: random.Random, valid: bool) -> str:
    body = "".join(str(r.randint(0, 9)) for _ in range(15))
    last = next(d for d in "0123456789" if luhn(body + d))
    return body + (last if valid else str((int(last) + r.randint(1, 9)) % 10))


def generated(count: int, seed: int = 5) -> list[tuple[str, list[Span]]]:
    """Zones with one thing of interest each: a form that the base patterns miss, or something that only looks like one."""
    r = random.Random(seed)
    num = lambda k: "".join(str(r.randint(0, 9)) for _ in range(k))
    host = lambda: _word(r) + r.choice(("", str(r.randint(0, 9))))

    def email() -> str:
        at, dot = r.choice((("[at]", "[dot]"), ("(at)", "(dot)"), ("at", "dot"), ("[AT]", "[DOT]"), ("AT", "DOT"), ("(at)", "."), ("[at]", ".")))
        gap = " " if at in ("at", "AT") else r.choice((" ", ""))
        end = r.choice(("com", "org", "net", "de", "fr"))
        dotted = f"{gap}{dot}{gap}" if dot != "." else "."
        return _word(r) + r.choice(("", num(2))) + f"{gap}{at}{gap}" + host() + (dotted if dot != "." else f" dot ") + end

    def phone() -> str:
        a, b, c = str(r.randint(2, 9)) + num(2), r.choice(("555", num(3))), num(4)
        return r.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"1-{a}-{b}-{c}", f"1 ({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}.{b}.{c}"))

    def card() -> str:
        n = _card(r, True)
        return r.choice((".", " / ", "/")).join((n[:4], n[4:8], n[8:12], n[12:]))

    def ip() -> str:
        return r.choice(("[.]", "(.)")).join(str(r.randint(0, 255)) for _ in range(4))

    def beside() -> tuple[str, list[Span]]:
        """Two numbers side by side, which a pattern takes for one and drops."""
        own = r.choice((f"+{r.randint(1, 9)} ({num(3)}) {num(3)}-{num(4)}", f"+{num(2)}-{num(2)}-{num(7)}", _card(r, True), _card(r, False)))
        other = r.choice((".".join(str(r.randint(10, 255)) for _ in range(4)), _card(r, True), _card(r, False), num(r.randint(6, 11))))
        kinds = [("phone" if own[0] == "+" else "card" if luhn(own) else OUTSIDE, own), ("card" if len(other) == 16 and luhn(other) else OUTSIDE, other)]
        if own[0] != "+" and r.random() < 0.5:
            kinds.reverse()
        spans = [(kind, at, at + len(x)) for (kind, x), at in zip(kinds, (0, len(kinds[0][1]) + 1), strict=True) if kind != OUTSIDE]
        return f"{kinds[0][1]} {kinds[1][1]}", spans

    def nothing() -> str:
        n = _card(r, False)
        return r.choice((
            n, num(r.randint(7, 15)), num(13), " ".join((n[:4], n[4:8], n[8:12], n[12:])), f"{r.randint(1900, 2100)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1900, 2100)}",
            f"{r.randint(1900, 2100)}-{r.randint(1, 12):02}-{r.randint(1, 28):02} {r.randint(0, 23):02}:{r.randint(0, 59):02}:{r.randint(0, 59):02}", f"{r.randint(300, 999)}.{r.randint(0, 999)}.{r.randint(0, 99)}.{r.randint(256, 999)}",
            f"{num(3)} {num(3)} {num(3)} {num(3)}", f"{r.randint(1, 9)}.{num(3)}.{num(3)}.{num(3)}", f"{num(r.randint(1, 3))}-{num(8)}", f"{_word(r)} at {_word(r)} {_word(r)} dot {_word(r)}", f"{num(7)}{_word(r)}{num(8)}",
            f"978-{num(1)}-{num(4)}-{num(4)}-{num(1)}", f"{num(4)}-{num(4)}", f"{num(6)}/{num(4)}", f"{num(2)} {num(2)} {num(2)} {num(2)}", f"{num(8)} {num(8)}", f"[{num(4)}] {num(4)} ({num(4)})",
        ))

    out = []
    for _ in range(count):
        kind = r.choice((*KINDS, "beside", "beside", OUTSIDE, OUTSIDE, OUTSIDE, OUTSIDE))
        if kind == "beside":
            what, inner = beside()
            kind = OUTSIDE
        else:
            what = {"email": email, "ip": ip, "card": card, "phone": phone, OUTSIDE: nothing}[kind]()
            inner = [(kind, 0, len(what))] if kind != OUTSIDE else []
        cue = r.choice(CUES[kind]) + r.choice((" ", ": ")) if kind != OUTSIDE and r.random() < 0.4 else ""
        lead = " ".join(_word(r) for _ in range(r.randint(0, 4)))
        lead = f"{lead} {cue}" if lead else cue
        tail = r.choice((" ", ". ", ", ")) + " ".join(_word(r) for _ in range(r.randint(0, 4)))
        out.append((lead + what + tail, [(k, len(lead) + a, len(lead) + b) for k, a, b in inner]))
    return out


def examples(generated_texts: list[tuple[str, list[Span]]]) -> Iterator[tuple[list[Token], list[Segment]]]:
    """The zones of texts as the field meets them, between the base spans, with the segments that are to be found there."""
    for text, spans in generated_texts:
        base = base_spans(text)
        for a, b in zones(text, base):
            toks = tokens(text[a:b], a)
            begins, ends = {x: k for k, (_, x, _) in enumerate(toks)}, {x: k + 1 for k, (_, _, x) in enumerate(toks)}
            yield toks, [(begins[x], ends[y], kind) for kind, x, y in spans if (kind, x, y) not in base and x in begins and y in ends]


_TRAINED: list[dict[tuple[str, str], float]] = []


def trained_weights() -> dict[tuple[str, str], float]:
    if not _TRAINED:
        _TRAINED.append(SemiMarkov(KINDS, candidates, span_features).fit(list(examples(generated(1200)))).weights)
    return _TRAINED[0]


def all_spans(text: str, field: SemiMarkov) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans with those that the field adds between them."""
    base = base_spans(text)
    found = list(base)
    for a, b in zones(text, base):
        toks = tokens(text[a:b], a)
        found += [(kind, toks[i][1], toks[j - 1][2]) for i, j, kind in field.decode(toks)]
    return base, in_order(found)


def redacted(text: str, spans: list[Span]) -> str:
    """Each span, or run of overlapping spans, gives way to the name of its first kind in brackets."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _scan(emit, names: list[str], types: list[pa.DataType], weights: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = SemiMarkov(KINDS, candidates, span_features, weights)
        for batch in arrow_text.slices(batches):
            out: list[list] = [[] for _ in names]
            for doc, text in zip(arrow_text.column(batch, "doc_id").to_pylist(), arrow_text.column(batch, "text").to_pylist(), strict=True):
                for column, value in zip(out, emit(doc, text, *all_spans(text, field)), strict=True):
                    column.append(value)
            yield pa.record_batch([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=names)

    return run


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base matches), base_sha256, spans (all of them)."""

    def emit(doc: int, text: str, base: list[Span], spans: list[Span]) -> tuple:
        kinds = [s[0] for s in base]
        return doc, *map(kinds.count, KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    types = [pa.int64()] * 5 + [pa.string()] * 2
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return id_and_text(docs, id_col, text_col).mapInArrow(_scan(emit, names, types, trained_weights()), schema)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span of their texts replaced, and the new length in ``length_col``; other columns as they are."""
    weights = trained_weights()

    def change(texts: list[str]) -> list[str]:
        field = SemiMarkov(KINDS, candidates, span_features, weights)
        return [redacted(t, all_spans(t, field)[1]) for t in texts]

    return arrow_text.with_texts(docs, change, text_col, length_col)
