"""A semi-Markov conditional random field over zones of text.

A zone is a list of tokens. A labelling cuts it into segments: a single token outside any entity, or an entity of at most
``LONGEST`` tokens. Each candidate segment is scored as a whole, with features of its complete span, and the best
cut is found by dynamic programming over ends, lengths and types together. Decoding scores a candidate when its end is
reached and keeps two numbers for each token and type, so a zone may be as long as a text. Training maximises the
conditional likelihood by stochastic gradient with forward-backward sums over all cuts.
"""

from __future__ import annotations

import math
import random
import re
from array import array
from collections.abc import Iterable, Iterator

OUTSIDE = "-"
LONGEST = 24
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
Token = tuple[str, int, int]
Segment = tuple[int, int, str]


def tokens(text: str, begin: int = 0) -> list[Token]:
    return [(m[0], begin + m.start(), begin + m.end()) for m in TOKEN.finditer(text)]


class SemiMarkov:
    def __init__(self, labels: Iterable[str], candidates, span_features, weights: dict[tuple[str, str], float] | None = None) -> None:
        """candidates(tokens) -> (i, j) pairs in order of i; span_features(tokens, i, j) -> names of the features that hold."""
        self.labels = list(labels)
        self.candidates, self.span_features = candidates, span_features
        self.weights = weights if weights is not None else {}

    def _outside(self, word: str) -> list[tuple[str, str]]:
        kind = "figures" if word[0].isdigit() else "word" if word[0].isalpha() else word
        return [(OUTSIDE, f"kind {kind}"), (OUTSIDE, f"size {min(len(word), 6)} {word[0].isdigit()}")]

    def by_end(self, toks: list[Token]) -> Iterator[tuple[int, list[int]]]:
        """For each end from 1 on the beginnings of the candidates that end there."""
        waiting: dict[int, list[int]] = {}
        end = 1
        for i, j in self.candidates(toks):
            while end <= i:
                yield end, waiting.pop(end, [])
                end += 1
            if j - i <= LONGEST:
                waiting.setdefault(j, []).append(i)
        for j in range(end, len(toks) + 1):
            yield j, waiting.pop(j, [])

    def lattice(self, toks: list[Token]) -> list[list[tuple[int, str, list[tuple[str, str]]]]]:
        """For each end the segments that end there: begin, label, features. For training, on short zones."""
        ends: list[list] = [[]]
        for j, begins in self.by_end(toks):
            here = [(j - 1, OUTSIDE, self._outside(toks[j - 1][0]))]
            for i in begins:
                held = self.span_features(toks, i, j)
                here += [(i, label, [(label, f) for f in held]) for label in self.labels]
            ends.append(here)
        return ends

    def _score(self, features: list[tuple[str, str]]) -> float:
        return sum(self.weights.get(f, 0.0) for f in features)

    def decode(self, toks: list[Token]) -> list[Segment]:
        """The entities of the best cut."""
        kinds, weight = [OUTSIDE, *self.labels], self.weights.get
        then = [[weight((x, f"then {y}"), 0.0) for x in kinds] for y in kinds]
        width = len(kinds)
        recent: list[list[float] | None] = [None] * (LONGEST + 1)  # scores of the last ends, by type
        recent[0] = [0.0] + [-math.inf] * (width - 1)
        begin, before = array("i", [-1] * width), array("b", [0] * width)
        outside: dict[str, float] = {}
        any_found = False
        for j, begins in self.by_end(toks):
            word = toks[j - 1][0]
            if word not in outside:
                if len(outside) > 10_000:
                    outside.clear()
                outside[word] = self._score(self._outside(word))
            arcs = [(j - 1, 0, outside[word])]
            for i in begins:
                held = self.span_features(toks, i, j)
                arcs += [(i, k, sum(weight((label, f), 0.0) for f in held)) for k, label in enumerate(self.labels, 1)]
            here, begin_here, before_here = [-math.inf] * width, [-1] * width, [0] * width
            for i, kind, own in arcs:
                for x, score in enumerate(recent[i % (LONGEST + 1)]):
                    total = score + own + then[kind][x]
                    if total > here[kind]:
                        here[kind], begin_here[kind], before_here[kind] = total, i, x
            any_found |= len(arcs) > 1
            recent[j % (LONGEST + 1)] = here
            begin.extend(begin_here)
            before.extend(before_here)
        if not any_found:
            return []
        found: list[Segment] = []
        j = len(toks)
        last = recent[j % (LONGEST + 1)]
        kind = last.index(max(last))
        while j > 0:
            i, x = begin[j * width + kind], before[j * width + kind]
            if kind:
                found.append((i, j, kinds[kind]))
            j, kind = i, x
        return found[::-1]

    def gradient(self, toks: list[Token], gold: list[Segment]) -> dict[tuple[str, str], float]:
        """Features of the gold cut less their expectation."""
        ends = self.lattice(toks)
        n = len(toks)
        forward: list[dict[str, float]] = [{OUTSIDE: 0.0}] + [{} for _ in range(n)]
        arcs = []
        for j in range(1, n + 1):
            terms: dict[str, list[float]] = {}
            for i, label, features in ends[j]:
                own = self._score(features)
                for before, score in forward[i].items():
                    step = own + self.weights.get((before, f"then {label}"), 0.0)
                    arcs.append((i, j, before, label, features, step))
                    terms.setdefault(label, []).append(score + step)
            forward[j] = {label: _log_sum(x) for label, x in terms.items()}
        backward: list[dict[str, list[float]]] = [{} for _ in range(n + 1)]
        backward[n] = {label: [0.0] for label in forward[n]}
        total = _log_sum(list(forward[n].values()))
        out: dict[tuple[str, str], float] = {}
        after: list[dict[str, float]] = [{} for _ in range(n + 1)]
        for i, j, before, label, features, step in reversed(arcs):  # arcs are in order of their ends
            if not after[j]:
                after[j] = {x: _log_sum(v) for x, v in backward[j].items()}
            if label not in after[j]:
                continue
            beyond = after[j][label]
            backward[i].setdefault(before, []).append(step + beyond)
            chance = math.exp(forward[i][before] + step + beyond - total)
            for f in (*features, (before, f"then {label}")):
                out[f] = out.get(f, 0.0) - chance
        inside = {k: (i, j, label) for i, j, label in gold for k in range(i, j)}
        j, before = 0, OUTSIDE
        while j < n:
            i, end, label = inside.get(j, (j, j + 1, OUTSIDE))
            features = next((f for b, x, f in ends[end] if b == i and x == label), None)
            if features is None:
                return {}
            for f in (*features, (before, f"then {label}")):
                out[f] = out.get(f, 0.0) + 1.0
            j, before = end, label
        return out

    def fit(self, examples: list[tuple[list[Token], list[Segment]]], rounds: int = 6, rate: float = 0.3, decay: float = 1e-4, seed: int = 11) -> SemiMarkov:
        squares: dict[tuple[str, str], float] = {}
        order = list(range(len(examples)))
        chooser = random.Random(seed)
        for _ in range(rounds):
            chooser.shuffle(order)
            for k in order:
                for f, g in self.gradient(*examples[k]).items():
                    g -= decay * self.weights.get(f, 0.0)
                    squares[f] = squares.get(f, 1e-6) + g * g
                    self.weights[f] = self.weights.get(f, 0.0) + rate * g / math.sqrt(squares[f])
        return self


def _log_sum(values: list[float]) -> float:
    most = max(values)
    return most + math.log(sum(math.exp(v - most) for v in values))
