"""Removal of repeated passages by external, induced suffix sorting.

A byte goes if it is covered by a string of ``length`` bytes that also starts anywhere else in the corpus.

Sorting every suffix of a corpus is what induced sorting avoids: it samples suffixes by a local rule, names the
substrings at the samples, recurs where names do not decide the order, sorts the sampled suffixes and induces all other
positions from them. The levels here are:

1. *Sample and name.* Position p is a sample if it holds the smallest hash of an 8-byte gram in some window of ``SPAN``
   grams; every text position i is assigned to the sample of the window that starts at i, a rule that reads nothing
   but the ``length`` bytes from i on. So two equal strings are assigned to samples at equal distance, and from
   there on share a *core* of ``length - SPAN + 1`` bytes. The name of a sample is the hash of its core.
   A name that occurs once ends here: none of its positions starts a repeated string.
2. *Equal contexts.* Samples whose whole *context* (all strings of the positions assigned to them) is equal are one
   tuple with a count; a name that stands for one context is decided by that, however often it occurs.
3. *Recur.* A name with more than ``HOT_CONTEXTS`` contexts (the rim of a passage that a large part of the corpus holds)
   does not decide enough for one task. Its contexts are cut into narrower ranges of distances; all strings of a range
   share more bytes than those of the whole, so ranges get longer names, and are taken through steps 1 to 4 again
   (:func:`_recursed`). A range of one distance is named by its whole string.
4. *Sort and induce.* The other tuples are dealt out by name. A shard pushes its suffix tuples into a disk-backed
   priority queue (:class:`SuffixQueue`), which returns them in lexicographic order, each with the common-prefix value to
   the one before: the sorted runs hold these values, and the merge derives new ones from them. Going backwards
   from the samples, byte by byte, the tuples of equal left context are dealt stably by the preceding byte, as induced
   sorting does, and the common-prefix values of new neighbours are range minima of the old ones (:func:`induce`). At
   distance d, a position starts a repeated string if it shares ``length - d`` bytes with a neighbour.

A task holds one block of tuples (``INDUCED_AT_ONCE``, and the rest of the last name) and one queue buffer in memory,
whatever the shard. Names and contexts are joined on 128 bits of hash; a name that collides costs work and no correctness.

Defined results: a null text is the empty text; texts shorter than ``length`` are never changed; repeated rows (same id
or not) are separate documents and hence repeats of each other; a null id stays null; an empty table gives an empty
table; other columns are ignored. Spans never cross documents. A row is known by its id and the hash of its text, so
the input may come in another order each time it is read; rows equal in both have equal results.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrow_text
from .storage import delete, discard, id_and_text, recorded, stage_table, sweep

SPAN, GRAM = 192, 8
#: Names with so many different contexts are sorted; with fewer nothing is left to decide, with more they recur.
SORTED_FROM, HOT_CONTEXTS = 2, 512
#: Distances in a range, at each recursion.
WIDTHS = (48, 12, 3, 1)
#: Window starts looked at together, contexts induced together, bytes of tuples a queue holds before it writes a run.
BLOCK, INDUCED_AT_ONCE, QUEUE_BYTES = 1 << 20, 8192, 48 << 20


def _smallest_grams(data: np.ndarray) -> np.ndarray:
    """For each window of SPAN grams the place of the smallest gram hash, leftmost among equals."""
    grams = np.ndarray((data.size - GRAM + 1,), "<u8", np.ascontiguousarray(data), strides=(1,))
    key = grams * np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    key &= np.uint64(0xFFFFFFFF00000000)
    key |= np.arange(key.size, dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < SPAN:
        key = np.minimum(key[: key.size - (SPAN - width)], key[SPAN - width :])
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def samples(text: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(p, first, last): sample places, and the first and last position assigned to each, block by block."""
    for begin in range(0, text.size - length + 1, BLOCK):
        end = min(begin + BLOCK, text.size - length + 1)
        place = _smallest_grams(text[begin : end + SPAN + GRAM - 2])[: end - begin] + begin
        cut = np.flatnonzero(np.diff(place)) + 1
        first = np.concatenate([[0], cut])
        yield place[first], first + begin, np.concatenate([cut, [place.size]]) - 1 + begin


def _samples_of(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    core_bytes = length - SPAN + 1
    hash64 = xxhash.xxh3_64_intdigest
    names = ["core", "context", "k1", "k2", "p", "most", "least"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[np.ndarray]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            arrays = [np.concatenate(x) for x in zip(*kept, strict=True)]
            kept.clear()
            return pa.record_batch([pa.array(a) for a in arrays], names=names)

        for batch in arrow_text.slices(batches):
            for k1, k2, text in zip(arrow_text.column(batch, "k1").to_pylist(), arrow_text.column(batch, "k2").to_pylist(), arrow_text.column(batch, "text"), strict=True):
                data = text.as_buffer()
                if data is None or data.size < length:
                    continue
                view = memoryview(data)
                for p, first, last in samples(np.frombuffer(data, np.uint8), length):
                    most, least = p - first, p - last
                    core = np.array([hash64(view[x : x + core_bytes]) for x in p.tolist()], np.uint64).view(np.int64)
                    context = [hash64(view[a : b + length], s) for a, b, s in zip(first.tolist(), last.tolist(), (most << 16 | least).tolist(), strict=True)]
                    kept.append([core, np.array(context, np.uint64).view(np.int64), np.full(p.size, k1, np.int64), np.full(p.size, k2, np.int64), p.astype(np.int64), most.astype(np.int32), least.astype(np.int32)])
                    held += p.size
                if held >= 50_000:
                    yield flush()
                    held = 0
        if kept:
            yield flush()

    return run


def _cut_contexts(length: int):
    """From documents with the samples asked of them: core, context, copies, most, least, data."""
    names = ["core", "context", "copies", "most", "least", "hot", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_text.slices(batches):
            out: list[list] = [[] for _ in names]
            size = 0
            for text, asked in zip(arrow_text.column(batch, "text"), arrow_text.column(batch, "asked"), strict=True):
                view = memoryview(text.as_buffer())
                for x in asked.as_py():
                    data = bytes(view[x["p"] - x["most"] : x["p"] - x["least"] + length])
                    for column, value in zip(out, (x["core"], x["context"], x["copies"], x["most"], x["least"], x["hot"], data), strict=True):
                        column.append(value)
                    size += len(data)
                if size > 4 << 20:
                    yield _contexts_batch(names, out)
                    out, size = [[] for _ in names], 0
            if out[0]:
                yield _contexts_batch(names, out)

    return run


def _contexts_batch(names: list[str], out: list[list]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
    return pa.record_batch([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=names)


def extended(one: bytes, two: bytes, common: int) -> int:
    """The length of the common prefix, of which ``common`` bytes are known."""
    n = min(len(one), len(two))
    while common < n:
        end = min(n, common + 64)
        if one[common:end] != two[common:end]:
            differ = int.from_bytes(one[common:end], "big") ^ int.from_bytes(two[common:end], "big")
            return common + (8 * (end - common) - differ.bit_length()) // 8
        common = end
    return n


def neighbour_prefixes(keys: list[bytes]) -> np.ndarray:
    """Of each key the length of the prefix it shares with the key before it; 0 for the first."""
    out = np.zeros(len(keys), np.int64)
    for k in range(0, len(keys) - 1, 2000):
        some = keys[k : k + 2001]
        sizes = np.array(list(map(len, some)))
        padded = np.zeros((len(some), sizes.max() + 1), np.uint8)
        inside = np.arange(padded.shape[1]) < sizes[:, None]
        padded[inside] = np.frombuffer(b"".join(some), np.uint8)
        differ = padded[1:] != padded[:-1]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), padded.shape[1])
        out[k + 1 : k + len(some)] = np.minimum(shared, np.minimum(sizes[1:], sizes[:-1]))
    return out


class SuffixQueue:
    """A priority queue of suffix tuples (key, payload) on disk; ties go by the payload's first entry. Runs are sorted and hold, with each tuple, the common prefix
    with the tuple before it; the merge carries these values on, so no byte known to be shared is compared again."""

    def __init__(self, limit: int = QUEUE_BYTES) -> None:
        self.limit, self.size = limit, 0
        self.buffer: list[tuple] = []
        self.runs: list = []

    def push(self, key: bytes, payload: tuple) -> None:
        self.buffer.append((key, payload))
        self.size += len(key) + 200
        if self.size >= self.limit:
            self.spill()

    def _sorted(self) -> Iterator[list[tuple]]:
        """The buffer in order, as lists of (key, common, payload); it is empty afterwards."""
        self.buffer.sort(key=lambda x: (x[0], x[1][0]))
        common = neighbour_prefixes([k for k, _ in self.buffer])
        for i in range(0, len(self.buffer), 1000):
            yield [(key, c, payload) for (key, payload), c in zip(self.buffer[i : i + 1000], common[i : i + 1000].tolist(), strict=True)]
        self.buffer, self.size = [], 0

    def spill(self) -> None:
        run = tempfile.TemporaryFile()
        for part in self._sorted():
            pickle.dump(part, run, pickle.HIGHEST_PROTOCOL)
        self.runs.append(run)

    @staticmethod
    def _read(run) -> Iterator[list[tuple]]:
        run.seek(0)
        while True:
            try:
                yield pickle.load(run)
            except EOFError:
                return

    def drain(self) -> Iterator[tuple[bytes, int, tuple]]:
        """All tuples by key, each with its common prefix with the one returned before it."""
        source = lambda parts, of: ((key, of, common, payload) for part in parts for key, common, payload in part)
        inputs = [source(self._read(run), of) for of, run in enumerate(self.runs)] + [source(self._sorted(), len(self.runs))]
        before, last = b"", -1
        for key, of, common, payload in heapq.merge(*inputs, key=lambda x: (x[0], x[3][0])):
            # ``common`` is shared with an earlier tuple of its run, so with all that came between.
            yield key, common if of == last else extended(before, key, common), payload
            before, last = key, of
        for run in self.runs:
            run.close()


def range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(values[first..last]) for each pair, both ends included, from a table of power-of-two spans."""
    span = last - first + 1
    level = np.frexp(span.astype(np.float64))[1] - 1
    out = np.empty(span.size, values.dtype)
    table, k = values, 0
    while True:
        here = level == k
        if here.any():
            out[here] = np.minimum(table[first[here]], table[last[here] - (1 << k) + 1])
        k += 1
        if k > level.max(initial=0):
            return out
        table = np.minimum(table[: -(1 << (k - 1))], table[1 << (k - 1) :])


def induce(name: np.ndarray, common: np.ndarray, left: np.ndarray, most: np.ndarray, length: int) -> np.ndarray:
    """Which strings recur: a row per tuple, in the order of the queue, a column per distance from the sample.

    name: numbers, equal for tuples of one name; common: bytes from the sample on that a tuple shares with the one before
    it; left: bytes before the sample, nearest first, ``most`` of them.
    """
    n = name.size
    found = np.zeros((n, SPAN), bool)
    common = common.copy()
    item, group = np.arange(n), np.concatenate([[0], np.cumsum(name[1:] != name[:-1])]) if n else np.zeros(0, np.int64)
    for d in range(SPAN):
        joined = (group[1:] == group[:-1]) & (common[1:] >= length - d)
        at = np.flatnonzero(joined)
        found[item[at], d] = True
        found[item[at + 1], d] = True
        # Those that reach one byte further back and are not alone stay.
        together = group[1:] == group[:-1]
        stay = np.flatnonzero((most[item] > d) & (np.append(together, False) | np.insert(together, 0, False)))
        if not stay.size:
            break
        if stay.size < item.size:
            common = np.minimum.reduceat(common[: stay[-1] + 1], np.concatenate([[0], stay[:-1] + 1]))
            item, group = item[stay], group[stay]
        byte = left[item, d].astype(np.int64)
        mixed = (group[1:] == group[:-1]) & (byte[1:] != byte[:-1])
        if mixed.any():
            key = group * 256 + byte
            order = np.argsort(key, kind="stable")
            key = key[order]
            same = np.flatnonzero(key[1:] == key[:-1]) + 1
            fresh = np.zeros(item.size, np.int64)
            if same.size:
                fresh[same] = range_minima(common, order[same - 1] + 1, order[same])
            item, common = item[order], fresh
            group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
    return found


_RUNS = "n1 long, n2 long, own long, runs array<struct<low:int,high:int>>"


def _sort_shard(length: int):
    """n1, n2 (name), own (context), runs of distances at which a position starts a repeated string; from tuples of
    n1, n2, own, copies, most, least, data."""

    def block(entries: list[tuple[bytes, int, tuple]]) -> pa.RecordBatch:
        n = len(entries)
        names = np.frombuffer(b"".join(k[:16] for k, _, _ in entries), ">i8").astype(np.int64).reshape(n, 2)
        own, copies, most, least = (np.array([p[k] for _, _, p in entries], np.int64) for k in range(4))
        common = np.maximum(np.array([c for _, c, _ in entries]) - 16, 0)
        left = np.zeros((n, SPAN), np.uint8)
        for i, (_, _, p) in enumerate(entries):
            if p[4]:
                left[i, : len(p[4])] = np.frombuffer(p[4], np.uint8)[::-1]
        number = np.concatenate([[0], np.cumsum((names[1:] != names[:-1]).any(axis=1))])
        found = induce(number, common, left, most, length)
        found[copies > 1] = True
        distance = np.arange(SPAN)
        found &= (distance >= least[:, None]) & (distance <= most[:, None])
        edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, begin = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        counts = np.bincount(row, minlength=n)
        keep = np.flatnonzero(counts)
        offsets = np.concatenate([[0], np.cumsum(counts[keep])])
        runs = pa.StructArray.from_arrays([pa.array(begin, pa.int32()), pa.array(end - 1, pa.int32())], names=["low", "high"])
        return pa.record_batch([pa.array(names[keep, 0]), pa.array(names[keep, 1]), pa.array(own[keep]), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs)], names=["n1", "n2", "own", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SuffixQueue()
        for batch in batches:
            columns = (arrow_text.column(batch, c).to_pylist() for c in ("n1", "n2", "own", "copies", "most", "least", "data"))
            for n1, n2, own, copies, most, least, data in zip(*columns, strict=True):
                queue.push(n1.to_bytes(8, "big", signed=True) + n2.to_bytes(8, "big", signed=True) + data[most:], (own, copies, most, least, data[:most]))
        entries: list[tuple[bytes, int, tuple]] = []
        for entry in queue.drain():
            if entries and (entry[0], entry[2][0]) == (entries[-1][0], entries[-1][2][0]):
                continue  # the same context, cut from rows that are equal in id and text
            if len(entries) >= INDUCED_AT_ONCE and entry[0][:16] != entries[-1][0][:16]:
                yield block(entries)
                entries = []
            entries.append(entry)
        if entries:
            yield block(entries)

    return run


def _narrower(length: int, width: int):
    """Contexts cut into ranges of at most ``width`` distances, each with the name of what all of its strings share, the
    hash of its own context, and where it lies: its nearest and farthest distance, and the one that counts as 0 in it."""
    names = ["core", "context", "copies", "begin", "low", "high", "n1", "n2", "own", "data"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_text.slices(batches, "data"):
            out: list[list] = [[] for _ in names]
            columns = (arrow_text.column(batch, c).to_pylist() for c in ("core", "context", "copies", "low", "high", "data"))
            for core, context, copies, low, high, data in zip(*columns, strict=True):
                for begin in range(low - low % width, high + 1, width):
                    near, far = max(low, begin), min(high, begin + width - 1)
                    part = data[high - far : high - near + length]
                    # Shared by all strings of the whole range, of which a context may hold a part.
                    shared = xxhash.xxh3_128_digest(part[far - begin : far - begin - width + 1 + length], begin)
                    n1, n2 = np.frombuffer(shared, ">i8").tolist()
                    own = xxhash.xxh3_64_intdigest(part, near << 16 | far) - (1 << 63)
                    for column, value in zip(out, (core, context, copies, begin, near, far, n1, n2, own, part), strict=True):
                        column.append(value)
            yield pa.record_batch([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=names)

    return run


def _recursed(contexts: DataFrame, length: int) -> DataFrame:
    """core, context, runs of names that have too many contexts for one task. At each recursion ranges of distances get
    narrower and names of what their strings share longer: a name that occurs once ends, one that stands for a single
    context is decided, one with up to ``HOT_CONTEXTS`` is sorted and induced like any other, the rest goes on."""
    schema = "core long, context long, copies long, begin int, low int, high int, n1 long, n2 long, own long, data binary"
    left = contexts.select("core", "context", "copies", F.col("least").alias("low"), F.col("most").alias("high"), "data")
    name, runs = ["n1", "n2"], []
    for width in WIDTHS:
        ranges = stage_table(left.mapInArrow(_narrower(length, width), schema), f"ranges{width}")
        equal = ranges.groupBy(*name, "own").agg(F.sum("copies").alias("copies"))  # equal contexts are one tuple
        kinds = equal.groupBy(*name).agg(F.sum("copies").alias("n"), F.count("*").alias("kinds")).filter("n > 1").select(*name, "kinds")
        kinds = stage_table(kinds, f"names{width}")
        decided = ranges.select("core", "context", "low", "high", *name).join(kinds.filter(F.col("kinds") < SORTED_FROM), name)
        runs.append(decided.select("core", "context", F.array(F.struct("low", "high")).alias("runs")))
        few = kinds.filter((F.col("kinds") >= SORTED_FROM) & (F.col("kinds") <= HOT_CONTEXTS)).select(*name)
        own = F.min(F.struct((F.col("high") - F.col("begin")).alias("most"), (F.col("low") - F.col("begin")).alias("least"), "data")).alias("at")
        tuples = ranges.join(few, name).groupBy(*name, "own").agg(F.sum("copies").alias("copies"), own).select(*name, "own", "copies", "at.*")
        found = stage_table(tuples.repartition(*name).mapInArrow(_sort_shard(length), _RUNS), f"runs{width}")
        back = ranges.select("core", "context", "begin", *name, "own").join(found, [*name, "own"])
        moved = F.transform("runs", lambda r: F.struct((r["low"] + F.col("begin")).alias("low"), (r["high"] + F.col("begin")).alias("high")))
        runs.append(back.select("core", "context", moved.alias("runs")))
        many = kinds.filter(F.col("kinds") > HOT_CONTEXTS).select(*name)
        left = ranges.join(many, name).select("core", "context", "copies", "low", "high", "data")
    return functools.reduce(DataFrame.unionAll, runs)


KEY = ["k1", "k2"]


def key_of(id_col: str, text_col: str) -> list[Column]:
    """k1, k2: the id (a stand-in where it is null) and the hash of the text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k1"), F.xxhash64(text_col).alias("k2")]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k1, k2, doc_id, text: each row under its id and the hash of its text."""
    return id_and_text(docs, id_col, text_col).select(*key_of("doc_id", "text"), "doc_id", "text")


def repeated_runs(rows: DataFrame, length: int = 400) -> DataFrame:
    """k1, k2, spans array<struct<start,end>>: where the documents of :func:`keyed` hold repeated strings; unmerged, in any order."""
    if length < SPAN + GRAM:
        raise ValueError(f"length must be at least {SPAN + GRAM}")
    with recorded() as made:
        spans = _spans(rows, length)
    delete(made, keep=spans)
    sweep(rows.sparkSession)
    return spans


def _spans(rows: DataFrame, length: int) -> DataFrame:
    sample = stage_table(rows.select(*KEY, "text").mapInArrow(_samples_of(length), "core long, context long, k1 long, k2 long, p long, most int, least int"), "samples")
    names = stage_table(sample.groupBy("core").count().filter("count > 1").select("core"), "names")
    members = stage_table(sample.join(names, "core"), "members")
    discard(sample, names)
    sweep(rows.sparkSession)
    contexts = members.groupBy("core", "context").agg(F.count("*").alias("copies"), F.min(F.struct(*KEY, "p", "most", "least")).alias("at"))
    contexts = stage_table(contexts.select("core", "context", "copies", "at.*"), "contexts")
    kinds = stage_table(contexts.groupBy("core").agg(F.count("*").alias("kinds")), "kinds")
    contexts = stage_table(contexts.join(kinds, "core"), "named")
    decided = contexts.filter((F.col("kinds") < SORTED_FROM) & (F.col("copies") > 1)).select("core", "context", F.array(F.struct(F.col("least").alias("low"), F.col("most").alias("high"))).alias("runs"))
    asked = contexts.filter(F.col("kinds") >= SORTED_FROM).groupBy(*KEY).agg(F.collect_list(F.struct("core", "context", "copies", "p", "most", "least", (F.col("kinds") > HOT_CONTEXTS).alias("hot"))).alias("asked"))
    cut = rows.select(*KEY, "text").join(asked, KEY).select("text", "asked")
    cut = stage_table(cut.mapInArrow(_cut_contexts(length), "core long, context long, copies long, most int, least int, hot boolean, data binary"), "cut")
    sweep(rows.sparkSession)
    tuples = cut.filter("not hot").select(F.col("core").alias("n1"), F.lit(0).cast("long").alias("n2"), F.col("context").alias("own"), "copies", "most", "least", "data")
    found = stage_table(tuples.repartition("n1").mapInArrow(_sort_shard(length), _RUNS), "runs").select(F.col("n1").alias("core"), F.col("own").alias("context"), "runs")
    runs = decided.unionAll(found)
    if not cut.filter("hot").isEmpty():
        runs = runs.unionAll(stage_table(_recursed(cut.filter("hot").dropDuplicates(["core", "context"]), length), "hot-runs"))
    spans = members.join(runs, ["core", "context"]).select(*KEY, "p", F.explode("runs").alias("r"))
    spans = spans.select(*KEY, F.struct((F.col("p") - F.col("r.high")).alias("start"), (F.col("p") - F.col("r.low") + length).alias("end")).alias("s"))
    return stage_table(spans.groupBy(*KEY).agg(F.collect_set("s").alias("spans")), "spans")


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans; touching spans join."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(starts[1:] > ends[:-1]) + 1
    return starts[np.concatenate([[0], new])], ends[np.concatenate([new - 1, [ends.size - 1]])]


def _merged_runs(spans: pa.Scalar) -> list[tuple[int, int]]:
    if not spans.is_valid:
        return []
    starts, ends = merged(*(spans.values.field(f).to_numpy() for f in ("start", "end")))
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def _removals(emit: Callable, names: list[str], types: list[pa.DataType], *through: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_text.slices(batches):
            out: list[list] = [[] for _ in names]
            spans = arrow_text.column(batch, "spans")
            for k, (doc, text) in enumerate(zip(arrow_text.column(batch, "doc_id").to_pylist(), arrow_text.column(batch, "text"), strict=True)):
                for column, value in zip(out, emit(doc, text.as_buffer().to_pybytes(), _merged_runs(spans[k])), strict=True):
                    column.append(value)
            made = [pa.array(x, t) for x, t in zip(out, types, strict=True)]
            yield pa.record_batch([*made, *(arrow_text.column(batch, c) for c in through)], names=[*names, *through])

    return run


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    if not runs:
        return data
    edges = [0, *[x for run in runs for x in run], len(data)]
    return b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])


def whole_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the part of a character at either end, so that what is left is valid UTF-8."""
    inner = []
    for a, b in runs:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            inner.append((a, b))
    return inner


def _with_runs(rows: DataFrame, length: int) -> DataFrame:
    return rows.join(repeated_runs(rows, length), KEY, "left")


def removal_digests(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", passage: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that are left); with ``passage`` also n_repeated, how many
    bytes are covered by repeated strings of that length, by a sort of its own. That column removes nothing."""

    def emit(doc: int, data: bytes, runs: list[tuple[int, int]]) -> tuple:
        return doc, len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(without(data, runs)).hexdigest()

    names, types = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    rows = keyed(docs, id_col, text_col)
    if passage is None:
        return _with_runs(rows, length).mapInArrow(_removals(emit, names, types), schema)
    covered = repeated_runs(rows, passage).mapInArrow(_covered, "k1 long, k2 long, n_repeated long")
    both = repeated_runs(rows, length).join(covered, KEY, "full")
    made = rows.join(both, KEY, "left").mapInArrow(_removals(emit, names, types, "n_repeated"), f"{schema}, n_repeated long")
    return made.withColumn("n_repeated", F.coalesce("n_repeated", F.lit(0)))


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [sum(b - a for a, b in _merged_runs(spans)) for spans in arrow_text.column(batch, "spans")]
        yield pa.record_batch([*(arrow_text.column(batch, c) for c in KEY), pa.array(sizes, pa.int64())], names=[*KEY, "n_repeated"])


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs``, all columns, with their texts without repeated passages, cut at whole characters, and the new length in
    ``length_col``."""
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    of, sized = plain.columns[docs.columns.index(text_col)], plain.columns[docs.columns.index(length_col)] if length_col else None
    rows = plain.withColumn(of, F.coalesce(F.col(of).cast("string"), F.lit("")))
    rows = rows.select(*key_of(plain.columns[docs.columns.index(id_col)], of), *rows.columns)
    runs = repeated_runs(rows.select(*KEY, F.col(of).alias("text")), length)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_text.slices(batches, of):
            left = []
            for text, spans in zip(arrow_text.column(batch, of), arrow_text.column(batch, "spans"), strict=True):
                data = text.as_buffer().to_pybytes()
                left.append(without(data, whole_characters(data, _merged_runs(spans))))
            texts = pa.array(left, pa.binary()).cast(arrow_text.column(batch, of).type)
            batch = batch.select([c for c in batch.schema.names if c != "spans"]).set_column(batch.schema.get_field_index(of), of, texts)
            if sized is not None:
                batch = batch.set_column(batch.schema.get_field_index(sized), sized, pc.utf8_length(texts).cast(pa.int64()))
            yield batch

    joined = rows.join(runs, KEY, "left").drop(*KEY)
    if sized is not None:
        joined = joined.withColumn(sized, F.col(sized).cast("long"))
    return joined.mapInArrow(change, joined.drop("spans").schema).toDF(*docs.columns)
