"""Near copies: texts linked by a Jaccard similarity of their word-shingle sets, without losing a pair.

Texts with the same set of shingles are one node. Candidates are, first, texts whose SimHash fingerprints collide in a ball
(:mod:`veilgrid.llm.simhash`): fingerprints of the sets, as many variants as lie within half the radius. They are near
copies for the most part, but not all of them. So, second, under any fixed order of shingles two sets of similarity t or more
share one of the first n - ceil(t n) + 1 shingles of each, n its size; the order puts rare shingles first, which only
decides how many texts meet. Every pair that shares one of its first shingles is compared, so that no link is lost.

Links are made in steps that leave fewer texts apart: with the colliding fingerprints, under each shingle every text is
compared with the one before it and with the first one, in the order of how much of a text is its own, which joins most of a large
group; this is repeated in shuffled orders as long as that pays. Then every pair that is still in different components is compared.

Pairs are ruled out by bounds that hold for certain; the others are verified on the sets themselves. The first shingle that
two sets share has nothing in common before it in either, so its place in a set tells how large the other one can be
(:func:`_reach`). Rows that reach no other size under a shingle go before rows are paired there, pairs that do not reach each
other are not made, and the counts by slot rule out most of the rest. Components are contracted as tables (:func:`veilgrid.llm.simhash.components`).

Defined results: a null text is the empty text; texts without words have the same, empty set and are copies of each
other; a text of fewer words than a shingle has one shingle, the whole sequence; repeated rows and rows with the same id
are separate rows; a null id stays null, names no component unless all ids of it are null, and is the last to be kept; an
empty table gives an empty table; other columns are ignored by :func:`near_copies` and kept by :func:`one_of_each`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import arrow_text
from .simhash import components, links, majority_bits, shingle_hashes
from .storage import PLACE, as_scan, delete, discard, place_of, recorded, stage_table, sweep

#: Of so many texts one is read for how common a shingle is, and so many of the commonest shingles are told to every task.
#: Both decide only which shingles are looked at first.
SAMPLED, COMMON = 16, 1 << 20
#: A text's shingles are counted in so many slots, for a bound of what two texts share.
SLOTS = 256
RADIUS = 2
#: Every pair is compared once there are at most so many for each text under a shingle; until then neighbours are, while that at
#: least halves the pairs left apart, in so many orders at most.
PAIRS_EACH, MOST_ORDERS = 4, 6


def shingle_set(text: bytes, words_each: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words_each), np.uint64))


def _slots(one: np.ndarray) -> bytes:
    """How many shingles fall into each slot; nothing where a count does not fit a byte."""
    counts = np.bincount((one >> np.uint64(56)).astype(np.int64), minlength=SLOTS)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def _each_shingle(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_text.slices(batches):
            sets = [shingle_set(t.as_buffer().to_pybytes(), words_each) for t in arrow_text.column(batch, "text")]
            yield pa.record_batch([pa.array(np.concatenate(sets).view(np.int64))], names=["shingle"])

    return run


_PRINT = "file long, at long, doc_id long, same long, row long, n int, bits long, node long, name binary, slots binary, first array<long>"


def _prints(words_each: int, similarity: float, common):
    """Of each text the size, fingerprint, name (whole, and in short as ``node``) and slots of its set, and so many of its
    rarest shingles, in order, that a set as similar has one of them among its own."""
    through = ["file", "at", "doc_id", "same", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = common.value
        for batch in arrow_text.slices(batches):
            sets = [shingle_set(t.as_buffer().to_pybytes(), words_each) for t in arrow_text.column(batch, "text")]
            sizes = np.array([s.size for s in sets])
            flat, ends = np.concatenate(sets), np.cumsum(sizes)
            place = np.minimum(np.searchsorted(known, flat), max(0, known.size - 1))
            count = np.where(known[place] == flat, often[place], 0) if known.size else np.zeros(flat.size, np.int64)
            first = []
            for one, c in zip(sets, np.split(count, ends[:-1]), strict=True):
                shared = math.ceil(similarity * one.size * (1 - 1e-9))  # what a set as similar has in common at least
                first.append(one[np.lexsort((one, c))[: one.size - shared + 1]])
            offsets = np.cumsum([0, *(f.size for f in first)])
            names = [xxhash.xxh3_128_digest(s) for s in sets]
            made = [
                pa.array(sizes, pa.int32()), pa.array(majority_bits(flat, ends).view(np.int64)), pa.array(np.frombuffer(b"".join(names), "<i8")[::2]), pa.array(names, pa.binary()), pa.array(map(_slots, sets), pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(first).view(np.int64))),
            ]
            yield pa.record_batch([*(arrow_text.column(batch, c) for c in through), *made], names=[*through, "n", "bits", "node", "name", "slots", "first"])

    return run


def _enough(shared, n, m, similarity: float):
    return shared >= similarity * (n + m - shared)


def _may_be_alike(similarity: float):
    """The pairs that the counts of their slots do not rule out: no slot shares more than the lesser count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (arrow_text.column(batch, c).to_pylist() for c in ("a_slots", "b_slots"))
            whole = [bool(x and y) for x, y in zip(left, right, strict=True)]
            counts = [np.frombuffer(b"".join(x if w else bytes(SLOTS) for x, w in zip(side, whole, strict=True)), np.uint8).reshape(-1, SLOTS) for side in (left, right)]
            n, m = (arrow_text.column(batch, c).to_numpy().astype(np.int64) for c in ("a_n", "b_n"))
            most = np.where(whole, np.minimum(*counts).sum(axis=1, dtype=np.int64), np.minimum(n, m))
            yield batch.select(["a", "b"]).filter(pa.array(_enough(most, n, m, similarity)))

    return run


def _alike(words_each: int, similarity: float):
    """The pairs whose shingle sets have at least ``similarity`` (Jaccard) in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}  # the sets of the slice before, as a text often comes in several pairs
        for batch in arrow_text.slices(batches, "a_text", "b_text"):
            now: dict[int, np.ndarray] = {}
            kept = []
            a, b = arrow_text.column(batch, "a").to_pylist(), arrow_text.column(batch, "b").to_pylist()
            for x, y, left, right in zip(a, b, arrow_text.column(batch, "a_text"), arrow_text.column(batch, "b_text"), strict=True):
                for node, text in ((x, left), (y, right)):
                    if node not in now:
                        now[node] = held[node] if node in held else shingle_set(text.as_buffer().to_pybytes(), words_each)
                one, two = now[x], now[y]
                both = np.sort(np.concatenate([one, two]), kind="stable")
                kept.append(_enough(int((both[1:] == both[:-1]).sum()), one.size, two.size, similarity))
            held = now
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def _beside(pairs: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b) of rows with these columns of both."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("row").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns)), side)
    return pairs


def _texts(scan: DataFrame, text: Column, nodes: DataFrame) -> DataFrame:
    """row, text of these nodes, as a stage table."""
    return stage_table(scan.select(*place_of(scan), text).join(nodes.select(*PLACE, "row"), PLACE).select("row", "text"), "texts")


def _verified(pairs: DataFrame, nodes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], words_each: int, similarity: float) -> DataFrame:
    """Of pairs (a, b) of rows those that are near copies, as a stage table. Only texts of pairs that no bound rules out are
    read. texts_of(pairs) -> row, text."""
    left = stage_table(_beside(pairs, nodes, "n", "slots").mapInArrow(_may_be_alike(similarity), "a long, b long"), "left")
    texts = texts_of(left)
    sweep(nodes.sparkSession)
    told = stage_table(_beside(left, texts, "text").mapInArrow(_alike(words_each, similarity), "a long, b long"), "told")
    discard(left)
    sweep(nodes.sparkSession)
    return told


def _pair(one: str, two: str) -> list:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def _ball_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs whose fingerprints are equal or met in a ball: each row with the first of its fingerprint, and the first ones
    of two fingerprints."""
    heads = stage_table(nodes.groupBy("bits").agg(F.min("row").alias("head")), "heads")
    equal = nodes.select("row", "bits").join(heads, "bits").filter("row <> head").select(*_pair("row", "head"))
    head = lambda c: heads.select(F.col("bits").alias(c), F.col("head").alias(f"{c}_head"))
    met = links(heads.select("bits"), RADIUS).join(head("a"), "a").join(head("b"), "b")
    return equal.unionAll(met.select(*_pair("a_head", "b_head")))


def _neighbours(rooted: DataFrame, order: int) -> DataFrame:
    """Pairs of different components under one shingle: each row with the one before it, and the first. In the first order that is
    the text with the fewest rarer shingles: of a group of copies the one with the least of its own, to which the others are closest."""
    turn = Window.partitionBy("shingle").orderBy(F.xxhash64("row", F.lit(order)) if order else F.col("place"), "row")
    beside = [F.struct(f("row").over(turn).alias("row"), f("root").over(turn).alias("root")).alias(name) for name, f in (("before", F.lag), ("lead", F.first))]
    met = rooted.select("row", "root", *beside).select("row", "root", F.explode(F.array("before", "lead")).alias("other")).filter("other.root <> root")
    return met.select("row", F.col("other.row").alias("other")).select(*_pair("row", "other")).distinct()


def _reach(similarity: float) -> Column:
    """The largest size of a set that is as similar and has its first common shingle with a set of size ``n`` at ``place`` there:
    both have in common n - place shingles at most, and as similar sets similarity / (1 + similarity) of both sizes at least."""
    least = similarity * (1 - 1e-9)
    return (F.col("n") - F.col("place")) * F.lit((1 + least) / least) - F.col("n") + F.lit(1e-6)


def _in_reach(rows: DataFrame, similarity: float) -> DataFrame:
    """The rows without those that reach no size under their shingle, or are reached by none there."""
    of = Window.partitionBy("shingle")
    sized = rows.withColumn("reach", _reach(similarity)).withColumn("shortest", F.min("n").over(of)).withColumn("farthest", F.max("reach").over(of))
    return sized.filter("reach >= shortest and n <= farthest").drop("reach", "shortest", "farthest")


def _rooted(met: DataFrame, stars: DataFrame, similarity: float) -> DataFrame:
    """The shared shingles under which rows of different components meet, with the root of each row."""
    rooted = met.join(stars.select(F.col("a").alias("row"), F.col("b").alias("root")), "row", "left").withColumn("root", F.coalesce("root", "row"))
    of = Window.partitionBy("shingle")
    apart = _in_reach(rooted, similarity).withColumn("low", F.min("root").over(of)).withColumn("high", F.max("root").over(of)).filter("low < high")
    return stage_table(apart.drop("low", "high"), "apart")


def _pairs_apart(apart: DataFrame) -> tuple[float, int]:
    """How many pairs of different components meet under a shingle, counted for each shingle, and how many rows."""
    sizes = apart.groupBy("shingle", "root").count().groupBy("shingle").agg(F.sum("count").alias("n"), F.sum(F.col("count").cast("double") * F.col("count")).alias("within"))
    left, rows = sizes.agg(F.sum((F.col("n").cast("double") * F.col("n") - F.col("within")) / 2), F.sum("n")).first()
    return left or 0.0, rows or 0


def _meetings(apart: DataFrame, similarity: float) -> DataFrame:
    """Pairs of different components under each first shingle they share, but those out of reach of each other there. A pair that
    is similar is within reach under the first one at least."""
    sized = apart.withColumn("reach", _reach(similarity))
    a, b = (sized.select("shingle", *(F.col(c).alias(f"{side}_{c}") for c in ("row", "n", "reach", "root"))) for side in ("a", "b"))
    near = (F.col("a_n") <= F.col("b_reach")) & (F.col("b_n") <= F.col("a_reach"))
    return a.join(b, "shingle").filter((F.col("a_row") < F.col("b_row")) & (F.col("a_root") != F.col("b_root")) & near)


def _every_pair(apart: DataFrame, similarity: float) -> DataFrame:
    """All pairs of different components that share a first shingle, but those that sizes and places rule out."""
    return _meetings(apart, similarity).select(F.col("a_row").alias("a"), F.col("b_row").alias("b")).distinct()


def _classes(scan: DataFrame, words_each: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """file, at, doc_id, same (hash of the text), root (a number for each group of near copies)."""
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    with recorded() as made:
        classes = _rows_by_class(scan, words_each, similarity, id_col, text_col)
    delete(made, keep=classes)
    sweep(scan.sparkSession)
    return classes


def _rows_by_class(scan: DataFrame, words_each: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    spark = scan.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    sampled = scan.select(*place_of(scan), text).filter(F.pmod(F.xxhash64(*PLACE), F.lit(SAMPLED)) == 0).select("text").mapInArrow(_each_shingle(words_each), "shingle long")
    often = sampled.groupBy("shingle").count().filter("count > 1").orderBy(F.desc("count")).limit(COMMON).toArrow()
    known, counts = often.column("shingle").to_numpy().view(np.uint64), often.column("count").to_numpy()
    order = np.argsort(known)
    common = spark.sparkContext.broadcast((known[order], counts[order]))  # at most 16 bytes for each of COMMON
    read = scan.select(*place_of(scan), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("same"), F.monotonically_increasing_id().alias("row"), text)
    prints = stage_table(read.mapInArrow(_prints(words_each, similarity, common), _PRINT), "prints")
    # Texts of the same set are one node, named after its first row. Shingles that nodes share are found first, which leaves few rows.
    heads = stage_table(prints.groupBy("name").agg(F.min("row").alias("head")), "heads")
    of_shingle = Window.partitionBy("shingle")
    each = prints.select("row", "node", "n", F.posexplode("first").alias("place", "shingle")).withColumn("low", F.min("node").over(of_shingle)).withColumn("high", F.max("node").over(of_shingle))
    shared = stage_table(_in_reach(each.filter("low <> high"), similarity).select("shingle", "row", "n", "place"), "shared")
    sweep(spark)
    met = stage_table(shared.join(heads.select(F.col("head").alias("row")), "row", "left_semi"), "met")
    discard(shared)
    nodes = stage_table(prints.select("file", "at", "row", "n", "bits", "slots").join(met.select("row").distinct(), "row"), "nodes")

    def of_pairs(pairs: DataFrame) -> DataFrame:
        asked = pairs.select(F.col("a").alias("row")).unionAll(pairs.select("b")).distinct()
        return _texts(scan, text, nodes.join(asked, "row"))

    alone = met.withColumn("root", F.col("row"))
    left, _ = _pairs_apart(alone)
    stars = components(_verified(_ball_pairs(nodes).unionAll(_neighbours(alone, 0)).distinct(), nodes, of_pairs, words_each, similarity))
    for k in range(1, MOST_ORDERS + 1):
        apart, before = _rooted(met, stars, similarity), left
        left, rows = _pairs_apart(apart)
        all_of_them = left <= PAIRS_EACH * rows or left > before / 2 or k == MOST_ORDERS
        more = _verified(_every_pair(apart, similarity) if all_of_them else _neighbours(apart, k), nodes, of_pairs, words_each, similarity)
        stars = components(stars.unionAll(more))
        discard(apart)
        if all_of_them:
            break
    of_heads = heads.join(stars.select(F.col("a").alias("head"), F.col("b").alias("root")), "head", "left").select("name", F.coalesce("root", "head").alias("root"))
    return stage_table(prints.select("file", "at", "doc_id", "same", "name").join(of_heads, "name").drop("name"), "classes")


def near_copies(docs: DataFrame, words_each: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, component_id (the smallest id of its group): groups of texts linked by a Jaccard similarity of their sets of
    ``words_each``-word shingles of ``similarity`` or more."""
    classes = _classes(as_scan(docs), words_each, similarity, id_col, text_col)
    named = stage_table(classes.groupBy("root").agg(F.min("doc_id").alias("component_id")), "named")
    return classes.join(named, "root").select("doc_id", "component_id")


def one_of_each(docs: DataFrame, words_each: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each group of near copies: the one of the smallest id; among rows with one id,
    by the hash of the text and by place."""
    scan = as_scan(docs)
    classes = _classes(scan, words_each, similarity, id_col, text_col)
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "same", *PLACE)
    kept = classes.groupBy("root").agg(F.min(rank).alias("kept"), F.count("*").alias("n")).filter("n > 1").select("root", "kept")
    gone = stage_table(classes.join(kept, "root").filter((F.col("file") != F.col("kept.file")) | (F.col("at") != F.col("kept.at"))).select(*PLACE), "gone")
    placed = scan.select(*place_of(scan), F.struct(*(F.col(f"`{c}`") for c in scan.columns)).alias("held"))
    discard(classes)
    return placed.join(gone, PLACE, "left_anti").select("held.*")
