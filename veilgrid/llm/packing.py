"""Hierarchical residual best-fit packing.

Every partition packs its pieces best-fit, longest first. Bins with next to no room left are final. Others rise as items,
with their pieces inside, through a tree: each node takes bins of ``FAN_IN`` nodes below and packs them best-fit again.

Which bins have to rise is no matter of a limit. After best-fit no two bins of a node fit together, so at most one of them
is half empty, and only that one can still be taken in by another bin. Each node above meets at most ``FAN_IN`` such bins,
and each of them needs at most one host; whatever hosts serve, the roomiest serve as well. So a node hands up its half-empty
bin and as many of its roomiest bins as all nodes above it together could fill, ``FAN_IN`` for each level, and closes
the rest: handing up every bin would save no sequence more. Pieces are dealt out so that a partition holds a bounded number.

Defined results: a null text is the empty text and still holds the end id; repeated rows are packed once each; a null
id stays null; an empty table gives an empty table; other columns are ignored. Texts are encoded whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrow_text
from .bpe import Model, WordCache, kept_in_worker, read_source, worker_model
from .storage import id_and_text, stage_table

FAN_IN = 8
#: Pieces that a partition packs at first.
PIECES = 1 << 19
_PIECE = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>"
_PIECE_TYPE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes into ``lengths``; each item goes into the fullest bin that still takes it, longest item first."""
    order = sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True)
    bins: list[list[int]] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = 0  # bit r: some open bin has room r
    for i in order:
        n = lengths[i]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            at = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
            bins[at].append(i)
        else:
            room, at = capacity, len(bins)
            bins.append([i])
        if room > n:
            open_bins[room - n].append(at)
            rooms |= 1 << (room - n)
    return bins


def _packed(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _packed_ids(model: Model):
    def make(words: list[str]) -> list[bytes]:
        ids, counts = model.encode_words(words)
        flat, ends = _packed(ids), (4 * np.cumsum(counts)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    return make


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32. Only a document longer than ``capacity`` is cut, its first piece being the shorter one."""
    source = docs.sparkSession.sparkContext.broadcast(read_source(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(source.value)
        cache = kept_in_worker(("packed", hash(source.value)), lambda: WordCache(model, _packed_ids(model)))
        end = _packed([end_id])
        for batch in arrow_text.slices(batches):
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc, stretches in zip(arrow_text.column(batch, "doc_id").to_pylist(), cache.cut(arrow_text.column(batch, "text").to_pylist()), strict=True):
                ids = b"".join([_packed([special]) if special is not None else b"".join(map(cache.__getitem__, words)) for words, special in stretches] + [end])
                n = len(ids) // 4
                starts = [0, *range((n - 1) % capacity + 1, n, capacity)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    for name, value in zip(out, (doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])), strict=True):
                        out[name].append(value)
            yield pa.record_batch([pa.array(out[f.name], f.type) for f in _PIECE_TYPE], names=list(out))

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _pack_round(level: int, capacity: int, nearly_full: int, hosts: int):
    """Packs a partition's items, each an array of pieces, into bins: sequence_id, final, pieces. hosts: how many of the
    roomiest bins rise beside the half-empty one; none from the last node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [b.column(0) for b in batches if b.num_rows]
        if not items:
            return
        inside = pa.concat_arrays(items)
        totals = np.add.reduceat(np.append(inside.flatten().field("length").to_numpy(), 0), inside.offsets.to_numpy()[:-1] - inside.offsets[0].as_py()).tolist()
        bins = best_fit(totals, capacity)
        fill = np.array([sum(map(totals.__getitem__, b)) for b in bins])
        final = np.ones(fill.size, bool)
        if hosts:
            final[np.argsort(fill, kind="stable")[: hosts + 1]] = False
            final |= fill >= nearly_full
        base = (level << 56) | (TaskContext.get().partitionId() << 32)
        order = np.array([i for b in bins for i in b])
        flat = inside.take(pa.array(order))
        sizes = np.diff(flat.offsets.to_numpy())
        ends = np.cumsum([len(b) for b in bins])
        offsets = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])]
        merged = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat.flatten())
        for k in range(0, len(bins), 20_000):
            yield pa.record_batch([pa.array(base + np.arange(k, min(k + 20_000, len(bins)))), pa.array(final[k : k + 20_000]), merged[k : k + 20_000]], names=["sequence_id", "final", "pieces"])

    return run


def pack(pieces: DataFrame, capacity: int, slack: int = 4) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset. A bin with at most ``slack`` tokens of room is final at once."""
    schema = f"sequence_id long, final boolean, pieces array<{_PIECE}>"
    items = pieces.select(F.array(F.struct("doc_id", "piece", "start", "length", "ids_crc32")).alias("pieces"))
    parts, level, done = max(1, items.rdd.getNumPartitions(), -(-pieces.count() // PIECES)), 0, []
    items = items.repartition(parts)
    above = 0
    while FAN_IN**above < parts:
        above += 1
    while True:
        bins = stage_table(items.mapInArrow(_pack_round(level, capacity, capacity - slack, FAN_IN * (above - level)), schema), f"bins{level}")
        done.append(bins.filter("final"))
        if level == above:
            break
        parts, level = -(-parts // FAN_IN), level + 1
        items = bins.filter("not final").select("pieces").repartition(parts)
    packed = done[0]
    for more in done[1:]:
        packed = packed.unionAll(more)
    ends = F.expr("aggregate(pieces, named_struct('at', 0L, 'offsets', cast(array() as array<bigint>)), (a, p) -> named_struct('at', a.at + p.length, 'offsets', array_append(a.offsets, a.at))).offsets")
    rows = packed.select("sequence_id", F.inline(F.arrays_zip("pieces", ends.alias("offset"))))
    return rows.select("pieces.*", "sequence_id", "offset")


def best_fit_packing(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs whole documents into sequences of at most ``capacity`` tokens."""
    return pack(stage_table(pieces_of(docs, vocabulary, capacity, end_id, id_col, text_col), "pieces"), capacity)
