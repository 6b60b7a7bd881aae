"""Byte-pair encoding over contiguous rank arrays.

A word is held as its part boundaries plus one rank for every pair of neighbouring parts. Encoding scans
the ranks for the smallest, deletes the boundary between that pair and refreshes the two ranks beside it.
The arrays of a word are a few entries long, so the scan beats any queue. :class:`RankArrays` keeps the arrays of many
short words as the rows of a matrix and takes one merge in each row at a time; a longer word has arrays of its own, and
one beyond ``LONG_WORD`` takes the same merges from a heap, since scanning would cost the square of its length.

The merges run once for each distinct pre-token that a worker meets; :class:`WordCache` remembers what came of it.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
from tokenizers import Tokenizer

MATRIX_WORD, LONG_WORD = 48, 400
#: So many words, of so many bytes together, are remembered; when there are more, the memory starts anew. Longer words
#: are forgotten with the slice they come from.
WORD_LIMIT, BYTE_LIMIT = 600_000, 24 << 20
_NEVER = np.int32(2**31 - 1)
_NO_RANK = 1 << 60


def merge_by_rank_array(word: list[str], ranks_of: dict[tuple[str, str], int]) -> list[str]:
    """One word, given as its first parts."""
    cuts = [0]
    for part in word:
        cuts.append(cuts[-1] + len(part))
    text = "".join(word)
    rank = [ranks_of.get((text[a:b], text[b:c]), _NO_RANK) for a, b, c in zip(cuts, cuts[1:], cuts[2:], strict=False)]
    while rank and (least := min(rank)) != _NO_RANK:
        i = rank.index(least)
        del cuts[i + 1], rank[i]
        if i < len(rank):
            rank[i] = ranks_of.get((text[cuts[i] : cuts[i + 1]], text[cuts[i + 1] : cuts[i + 2]]), _NO_RANK)
        if i:
            rank[i - 1] = ranks_of.get((text[cuts[i - 1] : cuts[i]], text[cuts[i] : cuts[i + 1]]), _NO_RANK)
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def merge_by_heap(word: list[str], ranks_of: dict[tuple[str, str], int]) -> list[str]:
    """The same merges in O(n log n), for words too long to scan again and again."""
    parts: list[str | None] = list(word)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, str, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (r := ranks_of.get((parts[i], parts[after[i]]))) is not None:
            heapq.heappush(heap, (r, i, parts[i], parts[after[i]]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= n or parts[j] != right:
            continue
        parts[i], parts[j] = left + right, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None]


class RankArrays:
    """Ids, and ranks of neighbouring ids, of many words: a row each."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray) -> None:
        """The pair (left[r], right[r]) has rank r and becomes merged[r]; ids are below 2 ** 16."""
        self.merged = merged.astype(np.int32)
        self.bits = max(4, int(len(left) * 8).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        for key, rank in zip(((left.astype(np.int64) << 16) | right).tolist(), range(len(left)), strict=True):
            at = self._slot(key)
            while self.keys[at] != -1:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.ranks[at] = key, rank

    def _slot(self, key):
        return ((key * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - self.bits)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """_NEVER where there is no such pair; a negative id has none."""
        key = (left.astype(np.int64) << 16) | right
        key[(left < 0) | (right < 0)] = -2
        at = self._slot(key)
        held = self.keys[at]
        out = np.where(held == key, self.ranks[at], _NEVER)
        probing = np.flatnonzero((held != key) & (held != -1))
        while probing.size:
            at[probing] = (at[probing] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[probing]]
            hit = held == key[probing]
            out[probing[hit]] = self.ranks[at[probing[hit]]]
            probing = probing[~hit & (held != -1)]
        return out

    def merge(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids: a row per word, padded with -1. Returns the ids after all merges, padded likewise, and how many there are."""
        out = np.full_like(ids, -1)
        rows = np.arange(len(ids))
        rank = self.rank_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while rows.size:
            if rank.shape[1] == 0:
                out[rows, : ids.shape[1]] = ids
                break
            at = rank.argmin(axis=1)
            least = rank[np.arange(rows.size), at]
            done = least == _NEVER
            if done.any():
                out[rows[done], : ids.shape[1]] = ids[done]
                rows, ids, rank, at, least = rows[~done], ids[~done], rank[~done], at[~done], least[~done]
                if not rows.size:
                    break
            every = np.arange(rows.size)
            ids[every, at] = self.merged[least]
            after = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, after + (after > at[:, None]), axis=1)
            after = after[:-1]
            rank = np.take_along_axis(rank, after + (after >= at[:, None]), axis=1)
            inner = np.flatnonzero(at < rank.shape[1])
            if inner.size:
                rank[inner, at[inner]] = self.rank_of(ids[inner, at[inner]], ids[inner, at[inner] + 1])
            inner = np.flatnonzero(at > 0)
            if inner.size:
                rank[inner, at[inner] - 1] = self.rank_of(ids[inner, at[inner] - 1], ids[inner, at[inner]])
        return out, (out >= 0).sum(axis=1)


def _byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where it is printable Latin-1, else the next character from U+0100 on."""
    out, spare = [], 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


ALPHABET = _byte_alphabet()


def _class(kind: str) -> str:
    """Characters below U+0250 of a general category, as the inside of a character class."""
    return "".join(f"\\u{c:04x}" for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)


_L, _N = _class("L"), _class("N")
#: In texts of these characters alone, this module's patterns say what the library's own say; others are left to the library.
_PLAIN = re.compile("[\t-\r -~\xa0-ɏ‐-‧]*")
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
#: The settings of a tokenizer file for which a pattern says what they do, without normaliser or with the one given.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORD_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
_WORD_NORMALISER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SETTINGS = {
    "bytes": (None, _BYTE_LEVEL),
    "words": (_WORD_NORMALISER, {"type": "Sequence", "pretokenizers": [_WORD_SPLIT, {**_BYTE_LEVEL, "use_regex": False}]}),
}
PATTERNS = {
    "bytes": re.compile(rf"{_ENDINGS}| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+"),
    "words": re.compile(rf"{_ENDINGS}|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+"),
}


class Model:
    """Vocabulary, merges and the library's own normaliser and pre-tokeniser, from the text of a tokenizer file."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model = spec["model"]
        if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("only plain byte-pair encoding is supported")
        if "ByteLevel" not in json.dumps(spec.get("pre_tokenizer")):
            raise ValueError("only byte-level pre-tokenisers are supported")
        if any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens must match as they are")
        self.library = Tokenizer.from_str(source)
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of = {i: t for t, i in (self.vocab | self.special).items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        #: Where the file's settings are known, plain texts are cut by a pattern; the library's own components cut all others.
        known = [k for k, settings in SETTINGS.items() if settings == (spec.get("normalizer"), spec.get("pre_tokenizer"))]
        self.pattern = PATTERNS[known[0]] if known else None
        self.lowered = known == ["words"]
        ids = lambda texts: np.array([self.vocab[t] for t in texts])
        self.arrays = RankArrays(ids(a for a, _ in pairs), ids(b for _, b in pairs), ids(a + b for a, b in pairs))
        self.first_ids = ids(ALPHABET).astype(np.int32)
        self.last_ids = ids(c + self.suffix for c in ALPHABET).astype(np.int32)

    def segments(self, text: str) -> Iterable[tuple[str, int | None]]:
        """Ordinary stretches, with None, and special strings, with their id, in order."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return [(text, None)]
        return [(s, self.special.get(s)) for s in self.special_pattern.split(text) if s]

    def pretokens(self, segment: str) -> list[str]:
        """The pre-tokens, as text; where the library has to cut, as text in the byte alphabet behind a NUL."""
        if self.pattern is not None and _PLAIN.fullmatch(segment):
            return self.pattern.findall(segment.lower() if self.lowered else segment)
        if self.library.normalizer is not None:
            segment = self.library.normalizer.normalize_str(segment)
        return [f"\0{w}" for w, _ in self.library.pre_tokenizer.pre_tokenize_str(segment)]

    def raw(self, word: str) -> bytes:
        return _unmapped(word[1:]) if word[:1] == "\0" else word.encode()

    def encode_long(self, raw: bytes) -> list[int]:
        parts = [ALPHABET[b] for b in raw]
        if parts:
            parts[-1] += self.suffix
        merge = merge_by_rank_array if len(parts) <= LONG_WORD else merge_by_heap
        return [self.vocab[p] for p in merge(parts, self.ranks)]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, how many for each word) for distinct pre-tokens."""
        raw = [self.raw(w) for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        counts = np.zeros(len(raw), np.int64)
        pieces: list[tuple[np.ndarray, np.ndarray]] = []
        below = 0
        for width in (8, 12, 16, 24, MATRIX_WORD):
            chosen = np.flatnonzero((sizes > below) & (sizes <= width))
            below = width
            for k in range(0, chosen.size, 20_000):
                some = chosen[k : k + 20_000]
                flat = np.frombuffer(b"".join([raw[i] for i in some.tolist()]), np.uint8)
                size = sizes[some]
                row = np.repeat(np.arange(some.size), size)
                column = np.arange(flat.size) - np.repeat(np.cumsum(size) - size, size)
                ids = np.full((some.size, width), -1, np.int32)
                ids[row, column] = self.first_ids[flat]
                ends = np.cumsum(size) - 1
                ids[np.arange(some.size), size - 1] = self.last_ids[flat[ends]]
                merged, counts[some] = self.arrays.merge(ids)
                pieces.append((some, merged[merged >= 0]))
        for i in np.flatnonzero(sizes > MATRIX_WORD).tolist():
            ids = np.array(self.encode_long(raw[i]), np.int32)
            counts[i] = ids.size
            pieces.append((np.array([i]), ids))
        starts = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int32)
        for some, ids in pieces:
            n = counts[some]
            out[np.repeat(starts[some] - (np.cumsum(n) - n), n) + np.arange(ids.size)] = ids
        return out, counts

    def encode_word(self, word: str) -> list[int]:
        return self.encode_words([word])[0].tolist()


_BYTE_OF = {c: b for b, c in enumerate(ALPHABET)}


def _unmapped(word: str) -> bytes:
    return bytes(map(_BYTE_OF.__getitem__, word))


class WordCache(dict):
    """What ``make`` gives for the distinct pre-tokens of the texts at hand; make(words) -> values."""

    def __init__(self, model: Model, make: Callable[[list[str]], Iterable]) -> None:
        super().__init__()
        self.model, self.make = model, make
        self.bytes, self.passing = 0, []

    def cut(self, texts: list[str]) -> list[list[tuple[list[str], int | None]]]:
        """For each text its stretches: pre-tokens, all of them known to the cache from now on, or a special id."""
        out, fresh = [], set()
        for text in texts:
            stretches = [([s] if special is not None else self.model.pretokens(s), special) for s, special in self.model.segments(text)]
            for words, special in stretches:
                if special is None:
                    fresh.update(words)
            out.append(stretches)
        for word in self.passing:
            del self[word]
        missing = fresh.difference(self)
        size = sum(map(len, missing))
        if len(self) + len(missing) > WORD_LIMIT or self.bytes + size > BYTE_LIMIT:
            self.clear()
            self.bytes = 0
            missing = fresh
            size = sum(map(len, missing))
        words = sorted(missing)
        self.update(zip(words, self.make(words), strict=True))
        self.passing = [w for w in words if len(w) > LONG_WORD]
        self.bytes += size - sum(map(len, self.passing))
        return out


_KEPT: dict[tuple, object] = {}


def kept_in_worker(key: tuple, make: Callable[[], object]):
    """One object for each key and Python worker: a worker that runs many tasks builds and fills it once."""
    if key not in _KEPT:
        _KEPT[key] = make()
        gc.freeze()  # vocabularies are large and stay: the collector need not look at them again
    return _KEPT[key]


def worker_model(source: str) -> Model:
    return kept_in_worker(("model", hash(source)), lambda: Model(source))


def read_source(path: str) -> str:
    """The tokenizer file on the driver; its text, of fixed size, is broadcast to the workers."""
    with open(path, encoding="utf-8") as f:
        return f.read()
