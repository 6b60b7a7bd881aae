"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's fingerprint has a bit set where more than half of the XXH64 hashes of its word shingles have it set. Two
fingerprints that differ in at most ``radius`` bits (an even number) have a common neighbour within ``radius / 2`` of
both, so every distinct fingerprint emits all its variants within half the radius, and the variants are the shuffle
key. Fingerprints that meet in a variant differ by at most ``radius``: in the order of fingerprints each is linked to
the one before it, which keeps every component whole without writing out all pairs. The links are deduplicated,
verified and contracted to components by alternating star operations, all as tables; nothing but a sum comes to the
driver. Copies collapse to one fingerprint before any variant is made, so a large group of copies is one node.

:mod:`veilgrid.llm.near_copies` is the form for a threshold of similarity.

Defined results: a null text is the empty text; a text without words has fingerprint zero and is linked like any other;
repeated rows are returned once each; a null id stays null and names no component unless all ids of it are null; an
empty table gives an empty table; other columns are ignored. Whole texts are hashed, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import arrow_text
from .storage import discard, id_and_text, stage_table

SEED = 42
_LANES = np.uint64(0x0101010101010101)


def majority_bits(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A fingerprint for each stretch of ``hashes`` that ends at ``ends``; 0 for an empty one.

    Each byte of a word counts one bit of each hash byte; a stretch is summed in steps of 255, before a byte overflows."""
    n, starts = ends.size, np.concatenate([[0], ends[:-1]])
    lengths = ends - starts
    steps = -(-lengths // 255)
    owner = np.repeat(np.arange(n), steps)
    inside = np.arange(owner.size) - np.repeat(np.cumsum(steps) - steps, steps)
    heads = starts[owner] + 255 * inside
    counts = np.zeros((n, 64), np.int64)
    if heads.size:
        for bit in range(8):
            part = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, heads)
            lanes = part.view(np.uint8).reshape(-1, 8).astype(np.int64)  # lane k holds bit 8 k + bit
            for lane in range(8):
                counts[:, 8 * lane + bit] = np.bincount(owner, lanes[:, lane], n).astype(np.int64)
    bits = 2 * counts > lengths[:, None]
    return (bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def shingle_hashes(text: bytes, words_each: int) -> list[int]:
    words = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII space characters
    if not words:
        return []
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    stop = np.cumsum(size) - 1
    k = min(words_each, len(words))
    begin = (stop - size + 1)[: len(words) - k + 1].tolist()
    of = xxhash.xxh64_intdigest
    return [of(joined[a:b], SEED) for a, b in zip(begin, stop[k - 1 :].tolist(), strict=True)]


def fingerprints(docs: DataFrame, words_each: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, bits (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_text.slices(batches):
            parts = [np.array(shingle_hashes(t.as_buffer().to_pybytes(), words_each), np.uint64) for t in arrow_text.column(batch, "text")]
            bits = majority_bits(np.concatenate(parts), np.cumsum([p.size for p in parts]))
            yield pa.record_batch([arrow_text.column(batch, "doc_id"), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, bits long")


def ball_masks(radius: int) -> list[int]:
    """All 64-bit masks with at most ``radius`` bits set, as signed longs."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """Verified links (a < b) between distinct fingerprints, as many as keep each component connected."""
    if radius % 2 or radius < 0:
        raise ValueError("radius must be even: half of it is the radius of the balls")
    variants = F.explode(F.array(*[F.col("bits").bitwiseXOR(F.lit(m).cast("long")) for m in ball_masks(radius // 2)]))
    met = nodes.select("bits", variants.alias("variant"))
    beside = F.lag("bits").over(Window.partitionBy("variant").orderBy("bits"))
    pairs = met.select(beside.alias("a"), F.col("bits").alias("b")).filter("a is not null").distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def _star(edges: DataFrame, upwards: bool) -> DataFrame:
    """One star operation. Upwards: a node's larger neighbours move to its least neighbour; else its smaller ones and itself."""
    if upwards:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    both = stage_table(both, "neighbours")
    least = stage_table(both.groupBy("a").agg(F.min("b").alias("low")), "least")
    root = F.least("a", "low")
    if upwards:
        moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), root.alias("b"))
    else:
        own = least.select("a", F.col("low").alias("b"))
        moved = both.join(least, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(own)
    out = stage_table(moved.filter("a <> b").distinct(), "stars")
    discard(both, least)
    return out


#: Links that a task contracts together.
CHUNK = 1 << 19


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as stars, by union-find over ``CHUNK`` of them at a time."""

    def stars(chunk: list[pa.RecordBatch]) -> pa.RecordBatch:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := root.get(top, top)) != top:
                top = up
            while x != top:
                root[x], x = top, root.get(x, x)
            return top

        for batch in chunk:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = find(a), find(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
        return pa.record_batch([pa.array(list(root), pa.int64()), pa.array([find(x) for x in root], pa.int64())], names=["a", "b"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK:
            yield stars(held)
            held, rows = [], 0
    if held:
        yield stars(held)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node with a link to a smaller one has just that link, and none to it."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionAll(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above")).filter("below > 1 or below = 1 and above = 1").isEmpty()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """a, b: every node that has a link to a smaller one of its component, with the smallest node of the component, as a stage
    table. Tasks contract up to ``CHUNK`` links each; while there is more than one such task, star operations over all links
    join what they left apart. ``links`` is a scan, or a union of scans."""
    edges = links
    for _ in range(most_rounds):
        tasks = max(1, -(-edges.count() // CHUNK))
        forest = edges.coalesce(tasks).mapInArrow(_forest, "a long, b long").filter("a <> b")
        contracted = stage_table(forest if tasks == 1 else forest.distinct(), "forest")
        if edges is not links:
            discard(edges)
        if tasks == 1 or _are_stars(contracted):
            return contracted
        raised = _star(contracted, upwards=True)
        edges = _star(raised, upwards=False)
        discard(contracted, raised)
        if _are_stars(edges):
            return edges
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _named(prints: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, bits, component_id from doc_id and bits, the distinct bits with their least id, and links between bits."""
    found = stage_table(found, "links")
    stars = components(found)
    discard(found)
    rooted = nodes.select("bits", "low").join(stars.select(F.col("a").alias("bits"), F.col("b").alias("root")), "bits", "left").select("bits", "low", F.coalesce("root", "bits").alias("root"))
    rooted = stage_table(rooted, "rooted")
    discard(stars)
    named = stage_table(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "roots")
    of_bits = stage_table(rooted.join(named, "root").select("bits", "component_id"), "classes")
    return prints.select("doc_id", "bits").join(of_bits, "bits")


def near_duplicates(docs: DataFrame, words_each: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id of the component)."""
    prints = stage_table(fingerprints(docs, words_each, id_col, text_col), "fingerprints")
    nodes = stage_table(prints.groupBy("bits").agg(F.min("doc_id").alias("low")), "nodes")
    out = _named(prints, nodes, links(nodes, radius))
    return out.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
