"""Joins and reductions of stage records, label files, decision logs and file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def last_of(records: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last in order; partial aggregation keeps a hot key to one row per task."""
    rest = [c for c in records.columns if c not in (key, order)]
    row = F.struct(*rest) if rest else F.struct(F.lit(1).alias("_"))
    return records.groupBy(key).agg(F.max_by(row, order).alias("r")).select(key, *(F.col(f"r.{c}") for c in rest))


def first_of(listing: DataFrame, key: str, value: str, order: Column) -> DataFrame:
    return listing.groupBy(key).agg(F.min_by(value, order).alias(value))


def report(post: DataFrame, sam: DataFrame, deid: DataFrame) -> DataFrame:
    """Post-processing records with the last segmentation and redaction record of their name; the time that the
    record itself carries wins, 0 where there is none. Post-processing rows are never merged."""
    s = last_of(sam, "name", "pos").withColumnRenamed("sam_time", "s_time").withColumn("has_sam", F.lit(True))
    d = last_of(deid, "name", "pos").withColumnRenamed("deid_time", "d_time").withColumn("has_deid", F.lit(True))
    joined = post.join(s, "name", "left").join(d, "name", "left")
    zero = F.lit(0.0)
    return joined.select(
        "name", F.coalesce("sam_time", "s_time", zero).alias("sam_time"), "post_time", F.coalesce("d_time", zero).alias("deid_time"),
        F.coalesce("has_sam", F.lit(False)).alias("has_sam"), F.coalesce("has_deid", F.lit(False)).alias("has_deid"),
    )


def latest_decisions(log: DataFrame) -> DataFrame:
    """relpath, status: the last row of each path decides; rows without a path are ignored."""
    return last_of(log.filter(F.trim("relpath") != ""), "relpath", "pos")


def latest_decisions_by_window(log: DataFrame) -> DataFrame:
    last = Window.partitionBy("relpath").orderBy(F.desc("pos"))
    return log.filter(F.trim("relpath") != "").withColumn("n", F.row_number().over(last)).filter("n = 1").select("relpath", "status")


def pending(scans: DataFrame, log: DataFrame) -> DataFrame:
    """Scans not decided as ok or bad; skipped ones come up again."""
    return scans.join(latest_decisions(log).filter(F.col("status").isin("ok", "bad")), "relpath", "left_anti")


def with_processed(scans: DataFrame, processed: DataFrame) -> DataFrame:
    return scans.join(processed.withColumn("found", F.lit(True)), "relpath", "left").select(*scans.columns, F.col("found").isNull().alias("missing"))


def first_existing(candidates: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """key, path: of each key's candidate paths (array, best first) the first that is listed."""
    each = candidates.select(key, F.posexplode(F.array_distinct("candidates")).alias("prio", "path"))
    return each.join(listing.select("path"), "path", "left_semi").groupBy(key).agg(F.min_by("path", "prio").alias("path"))


def zip_scores(boxes: DataFrame, key: str) -> DataFrame:
    """key, pos, box, score: scores by place, NaN where there is none."""
    each = boxes.select(key, "scores", F.posexplode("boxes").alias("pos", "box"))
    return each.select(key, "pos", "box", F.coalesce(F.get("scores", F.col("pos")), F.lit(float("nan"))).alias("score"))


def score_passes(score: Column, least: float) -> Column:
    """A missing score (NaN) passes."""
    return F.isnan(score) | (score >= least)


def dead_letters(results: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Sound rows without the error column, and failed rows."""
    return results.filter(F.col(error).isNull()).drop(error), results.filter(F.col(error).isNotNull())


#: A global rank is cut at so many values, taken from the rows with the least hashes.
CUTS = 200


def global_rank(rows: DataFrame, order: str, name: str) -> DataFrame:
    """rows with ``name``: 1, 2, ... in the order of a column (text or array of texts) over all rows. A bounded sample cuts
    the values into ranges of about equal size; rows are ranked within their range, after the sizes of the ranges before it. Only the
    sample and one size for each range leave the executors."""
    cuts = [r[0] for r in rows.filter(F.col(order).isNotNull()).select(order).orderBy(F.xxhash64(order), order).limit(CUTS).collect()]
    lit = lambda v: F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)
    at = sum((F.col(order) >= lit(c)).cast("int") for c in cuts) if cuts else F.lit(0)
    ranged = rows.withColumn("_range", F.coalesce(at, F.lit(-1)))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))  # at most CUTS + 2 rows
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    placed = ranged.withColumn("_within", within).join(sizes.select("_range", before.alias("_before")), "_range")
    return placed.withColumn(name, (F.col("_before") + F.col("_within")).cast("long")).drop("_range", "_within", "_before")
