"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

SPACE = re.compile("[\x20\x09-\x0d]+")


def words(text: str) -> list[str]:
    return [w for w in SPACE.split(text) if w]


def removed_repeats(texts: list[str], length: int = 400) -> list[tuple[int, int, int, str]]:
    data = [t.encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(covered)))
        kept = bytes(b for b, c in zip(d, covered, strict=True) if not c)
        out.append((len(d), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text: str, each: int = 3) -> int:
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(w[k : k + each]) for k in range(max(1, len(w) - each + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(ids: list[int], linked) -> dict[int, int]:
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def shingle_similarity(one: str, two: str, each: int = 5) -> float:
    sets = []
    for t in (one, two):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets.append({tuple(w[k : k + each]) for k in range(max(1, len(w) - each + 1))} if w else set())
    return len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1]))


def rule_counts(text: str) -> tuple[int, int, int, int, int]:
    w = words(text)
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if words(line):
            copies += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), copies, len(covered)


def _luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(digits[::-1])]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def personal_data(text: str) -> list[tuple[str, int, int]]:
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    kinds = ["email", "ip", "card", "phone"]
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
