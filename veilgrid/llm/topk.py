"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are sorted by length and cut into buckets, each a block of vectors of nearly the same length, eight or so to a slot; queries are cut
into blocks. A first round meets every query with the longest bucket and leaves each query a score that its k-th best
cannot fall below. In the second round that score becomes, for each bucket, a local cosine threshold: the least cosine
a member needs, given its length, to enter the result. Headers (the longest member of a slot, the least length that
some query of a block needs) are joined first, and a block is sent only to the slots where a threshold can be met. There a
threshold above 1 skips the bucket; a high one prunes by coordinates (a member's largest query coordinates must lie in
the interval that the threshold leaves); a low one prunes by length alone. What is left is verified by exact integer
products.

Every bound is widened by a relative ``SLACK`` so that rounding never drops a tie, and pruning needs a strictly lower
bound, so ties go to the smaller id among all rows.

Defined results: vectors that are null, empty or hold a null, NaN or infinity take no part, neither do rows with a null
id; rows with the same id are one row, with the least of their vectors; vectors of unequal sizes are compared as if the
shorter were padded with zeros; a component beyond 2 ** 28 after scaling raises an error, since scores might not fit
a long; a query with no other row has no result; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import stage_table

#: Members of a bucket, queries of a block: together they bound a task's matrix of products.
BUCKET, QUERIES = 2048, 512
#: From this local cosine threshold on, coordinates prune; so many of them are looked at.
COORDINATES_FROM, FOCUS = 0.7, 3
SLACK = 1e-9
_LIMIT = 1 << 28


def integer_vectors(rows: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v array<long>: floor(scale * x) of each component, of the rows that take part."""
    fits = lambda e: F.when(F.abs(F.lit(scale) * e.cast("double")) <= _LIMIT, F.floor(F.lit(scale) * e.cast("double"))).otherwise(F.raise_error(F.lit("a component is too large for exact scores")).cast("long"))
    kept = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x")).filter(F.col("vec_id").isNotNull())
    x = F.col("x")
    sound = x.isNotNull() & (F.size(x) > 0) & ~F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    return kept.filter(sound).select("vec_id", F.transform(x, fits).alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _blocks(size: int):
    """Rows of a partition, in order, as blocks: number, longest (largest squared length), n, width, ids, data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        vectors: list[np.ndarray] = []
        number = TaskContext.get().partitionId() << 32

        def block() -> pa.RecordBatch:
            width = max(map(len, vectors))
            data = np.zeros((len(vectors), width), np.int32)
            for i, v in enumerate(vectors):
                data[i, : len(v)] = v
            longest = int((data.astype(np.int64) ** 2).sum(axis=1).max())
            out = [[number], [longest], [len(ids)], [width], [np.array(ids, "<i8").tobytes()], [data.astype("<i4").tobytes()]]
            return pa.record_batch([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["number", "longest", "n", "width", "ids", "data"])

        for batch in batches:
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(vec_id)
                vectors.append(v.values.to_numpy())
                if len(ids) == size:
                    yield block()
                    number += 1
                    ids, vectors = [], []
        if ids:
            yield block()

    return run


_BLOCK = "number long, longest long, n int, width int, ids binary, data binary"


def _matrix(ids: bytes, data: bytes, width: int, to: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, "<i8")
    m = np.frombuffer(data, "<i4").reshape(found.size, width).astype(np.int64)
    return found, np.pad(m, ((0, 0), (0, to - width)))


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact: by floating point where every sum is below 2 ** 53, else in integers."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(p).max(initial=0)) * q.shape[1]
    if bound < 2.0**53:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    return q @ p.T


def _least_cosine(floor: np.ndarray, q_length: np.ndarray, longest: float) -> np.ndarray:
    """The local threshold: cosines below it cannot reach the floor in a bucket whose longest member is ``longest``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        t = floor / (q_length * longest)
    return np.where(floor > 0, np.where(q_length * longest > 0, t, np.inf), -np.inf) * (1 - SLACK)


def retrieve(q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, p_ids: np.ndarray, p: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vec id, score) of up to k members of one bucket for each query; ``floor``: a lower bound of its k-th score."""
    q_length, p_length = np.sqrt((q.astype(float) ** 2).sum(axis=1)), np.sqrt((p.astype(float) ** 2).sum(axis=1))
    order = np.lexsort((p_ids, -p_length))
    p, p_ids, p_length = p[order], p_ids[order], p_length[order]
    cosine = _least_cosine(floor, q_length, p_length[0])
    by_coordinate = np.flatnonzero((cosine >= COORDINATES_FROM) & (cosine <= 1))
    by_length = np.flatnonzero(cosine < COORDINATES_FROM)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def best(of: int, ids: np.ndarray, scores: np.ndarray) -> None:
        other = ids != q_ids[of]
        ids, scores = ids[other], scores[other]
        if np.isfinite(floor[of]):
            enough = scores >= floor[of]
            ids, scores = ids[enough], scores[enough]
        if ids.size > k:
            kth = np.partition(scores, ids.size - k)[ids.size - k]
            ids, scores = ids[scores >= kth], scores[scores >= kth]
        first = np.lexsort((ids, -scores))[:k]
        out.append((np.full(first.size, q_ids[of]), ids[first], scores[first]))

    if by_length.size:
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(floor[by_length] > 0, floor[by_length] / q_length[by_length], -np.inf) * (1 - SLACK)
        reach = np.searchsorted(-p_length, -need, side="right")  # members long enough, for each query
        scores = _products(q[by_length], p[: reach.max()])
        for row, of in enumerate(by_length.tolist()):
            best(of, p_ids[: reach[row]], scores[row, : reach[row]])
    if by_coordinate.size:
        unit = p / np.maximum(p_length, 1e-300)[:, None]
        ranked = {}
        for of in by_coordinate.tolist():
            t, direction = cosine[of], q[of] / q_length[of]
            keep = np.ones(len(p), bool)
            for c in np.argsort(-np.abs(direction))[:FOCUS].tolist():
                if c not in ranked:
                    ranked[c] = (r := np.argsort(unit[:, c], kind="stable"), unit[r, c])
                r, values = ranked[c]
                middle, half = direction[c] * t, np.sqrt(max(0.0, (1 - t * t) * (1 - direction[c] ** 2)))
                # The cosine may exceed t, which moves the middle of the interval towards the coordinate itself.
                low = -1.0 if -direction[c] >= t else middle - half
                high = 1.0 if direction[c] >= t else middle + half
                inside = np.zeros(len(p), bool)
                inside[r[np.searchsorted(values, low - 1e-7) : np.searchsorted(values, high + 1e-7, side="right")]] = True
                keep &= inside
            chosen = np.flatnonzero(keep)
            best(of, p_ids[chosen], _products(q[of : of + 1], p[chosen])[0])
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _meet(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                width = max(r["width"], r["q_width"])
                p_ids, p = _matrix(r["ids"], r["data"], r["width"], width)
                q_ids, q = _matrix(r["q_ids"], r["q_data"], r["q_width"], width)
                floor = np.full(q_ids.size, -np.inf)
                if r["floors"] is not None:
                    known = {x["query_id"]: x["floor"] for x in r["floors"]}
                    floor = np.array([known.get(i, -np.inf) for i in q_ids.tolist()], float)
                found = retrieve(q_ids, q, floor, p_ids, p, k)
                if found[0].size:
                    yield pa.record_batch([pa.array([r["q_number"]] * found[0].size, pa.int64()), *map(pa.array, found)], names=["q_number", "query_id", "vec_id", "score"])

    return run


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The header of each query block: its number, and the least length a candidate needs to enter the result of some query."""
    for batch in batches:
        need = []
        for r in batch.to_pylist():
            q_ids, q = _matrix(r["q_ids"], r["q_data"], r["q_width"], r["q_width"])
            known = {x["query_id"]: x["floor"] for x in r["floors"] or ()}
            floor = np.array([known.get(i, 0) for i in q_ids.tolist()], float)
            length = np.sqrt((q.astype(float) ** 2).sum(axis=1))
            with np.errstate(divide="ignore", invalid="ignore"):
                each = np.where(floor > 0, floor / length, 0.0)
            need.append(float(each.min()) * (1 - SLACK))
        yield pa.record_batch([batch.column(batch.schema.get_field_index("q_number")), pa.array(need, pa.float64())], names=["q_number", "need"])


#: Lengths fall into so many cells for each doubling, of which there are fewer than ``DOUBLINGS`` below the largest length.
CELLS, DOUBLINGS = 64, 48


def _cell(length: Column) -> Column:
    return F.floor(F.log2(length + 1) * CELLS).cast("int")


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(rows: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every`` the k rows with the highest products."""
    spark = rows.sparkSession
    vectors = stage_table(integer_vectors(rows, scale, id_col, vector_col), "vectors")
    squared = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    n = vectors.count()
    slots = max(1, -(-n // (8 * BUCKET)))
    by_length = vectors.withColumn("squared", squared).repartitionByRange(slots, F.desc("squared"), "vec_id").sortWithinPartitions(F.desc("squared"), "vec_id").select("vec_id", "v")
    buckets = stage_table(by_length.mapInArrow(_blocks(BUCKET), _BLOCK), "buckets")
    asked = vectors.filter(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = stage_table(asked.repartition(max(1, slots // every), "vec_id").mapInArrow(_blocks(QUERIES), _BLOCK), "queries")
    blocks = blocks.select(*(F.col(c).alias(f"q_{c}") for c in ("number", "longest", "n", "width", "ids", "data")))
    slotted = buckets.withColumn("slot", (F.shiftright("number", 32) + (F.col("number") % 4294967296)) % slots)
    first = buckets.agg(F.min("number")).first()[0]  # the longest bucket
    longest = F.broadcast(buckets.filter(F.col("number") == F.lit(first)).withColumn("number", F.lit(0).cast("long")))  # one bucket: at most BUCKET vectors
    result = "q_number long, query_id long, vec_id long, score long"
    pair = ["width", "ids", "data", "q_number", "q_width", "q_ids", "q_data", "floors"]
    unknown = F.lit(None).cast("array<struct<query_id:long,floor:long>>").alias("floors")
    seeds = stage_table(blocks.withColumn("number", F.pmod("q_number", F.lit(1))).join(longest, "number").select(*pair[:-1], unknown).mapInArrow(_meet(k), result), "seeds")
    floors = _best(seeds, k).filter(F.col("rank") == k).groupBy("q_number").agg(F.collect_list(F.struct("query_id", F.col("score").alias("floor"))).alias("floors"))
    blocks = stage_table(blocks.join(floors, "q_number", "left"), "floored")
    # Headers first: a block meets the slots whose longest member is as long as one of its queries needs.
    heads = slotted.filter(F.col("number") != F.lit(first)).groupBy("slot").agg(F.max("longest").alias("longest")).withColumn("reach", F.sqrt("longest") * (1 + SLACK))
    heads = heads.select("slot", "reach", _cell(F.col("reach")).alias("cell"))
    needs = blocks.mapInArrow(_needed, "q_number long, need double").withColumn("cell", F.explode(F.sequence(_cell(F.col("need")), F.lit(DOUBLINGS * CELLS))))
    meetings = needs.join(heads, "cell").filter("reach >= need").select("q_number", "slot")
    rest = blocks.join(meetings, "q_number").join(slotted.filter(F.col("number") != F.lit(first)), "slot").select(*pair).mapInArrow(_meet(k), result)
    out = _best(seeds.unionAll(rest), k)
    return out.select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, p.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, p.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM sound q JOIN sound p ON q.vec_id <> p.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
