"""Quality of predicted boxes against hand-labelled ones.

Coverage of a labelled box is the best single prediction's share of it, with predictions grown by the margin; a
prediction is outside if it touches no labelled box grown by the margin. The boxes of an image, labelled and predicted, are gathered by
one shuffle, and an Arrow batch of images is compared at a time; no pixels are carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import geometry as G

FULL = 0.999999


#: Pairs of a labelled box and a prediction that are compared at a time.
PAIRS_AT_ONCE = 1 << 21


def coverage(gt: Column, pred: Column, margin: float) -> Column:
    area = G.rect_area(gt)
    return F.when(area > 0, F.least(F.lit(1.0), G.intersection_area(gt, G.expand_rect(pred, margin)) / area)).otherwise(0.0)


def _together(gt: DataFrame, pred: DataFrame, *keys: str) -> DataFrame:
    """keys, boxes: labelled boxes and predictions of each image in one array, by one shuffle."""
    side = lambda rows, labelled: rows.select(*keys, F.struct(F.lit(labelled).alias("labelled"), F.col("ix").cast("bigint").alias("ix"), F.col("r")).alias("box"))
    return side(gt, True).unionAll(side(pred, False)).groupBy(*keys).agg(F.collect_list("box").alias("boxes"))


class _Compared:
    """The boxes of a batch of images: of each labelled box its best coverage, of each prediction whether it is outside."""

    def __init__(self, lists: pa.ListArray, margin: float) -> None:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = lists.flatten()
        owner = np.repeat(np.arange(len(lists)), sizes)
        labelled = rows.field("labelled").to_numpy(zero_copy_only=False).astype(bool)
        ix = rows.field("ix").to_numpy(zero_copy_only=False)
        sides = [rows.field("r").field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x1", "y1", "x2", "y2")]
        g, p = np.flatnonzero(labelled), np.flatnonzero(~labelled)
        self.images = len(lists)
        self.g_owner, self.p_owner, self.g_ix, self.p_ix = owner[g], owner[p], ix[g], ix[p]
        (gx1, gy1, gx2, gy2), (px1, py1, px2, py2) = ([v[k] for v in sides] for k in (g, p))
        area = np.maximum(0.0, gx2 - gx1) * np.maximum(0.0, gy2 - gy1)
        per_image = np.bincount(self.p_owner, minlength=self.images)
        starts = np.cumsum(per_image) - per_image
        counts = per_image[self.g_owner]
        self.coverage, self.outside = np.zeros(g.size), np.ones(p.size, bool)
        ends, at = np.cumsum(counts), 0
        while at < g.size:
            done = ends[at - 1] if at else 0
            until = max(at + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")))
            some = counts[at:until]
            one = np.repeat(np.arange(at, until), some)
            two = starts[self.g_owner[one]] + np.arange(one.size) - np.repeat(np.cumsum(some) - some, some)
            width = np.minimum(gx2[one], px2[two] + margin) - np.maximum(gx1[one], px1[two] - margin)
            height = np.minimum(gy2[one], py2[two] + margin) - np.maximum(gy1[one], py1[two] - margin)
            with np.errstate(divide="ignore", invalid="ignore"):
                share = np.where(area[one] > 0, np.minimum(1.0, np.maximum(0.0, width) * np.maximum(0.0, height) / area[one]), 0.0)
            np.maximum.at(self.coverage, one, share)
            touch = (px1[two] <= gx2[one] + margin) & (gx1[one] - margin <= px2[two]) & (py1[two] <= gy2[one] + margin) & (gy1[one] - margin <= py2[two])
            self.outside[two[touch]] = False
            at = until


def _by_batch(gt: DataFrame, pred: DataFrame, margin: float, keys: tuple[str, ...], fields: str, make) -> DataFrame:
    """keys and ``fields`` of make(compared) -> (images, columns) for each batch of images."""
    gathered = _together(gt, pred, *keys)
    schema = StructType([*(gathered.schema[k] for k in keys), *StructType.fromDDL(fields).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images, columns = make(_Compared(batch.column(len(keys)), margin))
            yield pa.record_batch([*(batch.column(k).take(pa.array(images)) for k in range(len(keys))), *map(pa.array, columns)], names=schema.names)

    return gathered.mapInArrow(run, schema)


def best_coverage(gt: DataFrame, pred: DataFrame, margin: float, *keys: str) -> DataFrame:
    """keys, ix, coverage of each labelled box; 0 without prediction or area. gt and pred: keys, ix, r."""
    return _by_batch(gt, pred, margin, keys, "ix bigint, coverage double", lambda c: (c.g_owner, (c.g_ix, c.coverage)))


def outside(gt: DataFrame, pred: DataFrame, margin: float, *keys: str) -> DataFrame:
    """keys, ix of the predictions that touch no labelled box of their image; all of them where it has none."""
    return _by_batch(gt, pred, margin, keys, "ix bigint", lambda c: (c.p_owner[c.outside], (c.p_ix[c.outside],)))


def universe(gt: DataFrame, pred: DataFrame, key: str = "img_id") -> DataFrame:
    """Every image with a label or a prediction, with the numbers of both."""
    side = lambda rows, g, p: rows.select(key, F.lit(g).cast("long").alias("n_gt"), F.lit(p).cast("long").alias("n_pred"))
    return side(gt, 1, 0).unionAll(side(pred, 0, 1)).groupBy(key).agg(F.sum("n_gt").alias("n_gt"), F.sum("n_pred").alias("n_pred"))


def per_image(gt: DataFrame, pred: DataFrame, margin: float, *keys: str) -> DataFrame:
    """keys, n_gt, n_pred, total, coverage (mean), n_full, n_uncovered, n_outside: one shuffle for all of them."""
    keys = keys or ("img_id",)

    def make(c: _Compared):
        count = lambda owner: np.bincount(owner, minlength=c.images).astype(np.int64)
        total = np.bincount(c.g_owner, c.coverage, c.images)
        return np.arange(c.images), (count(c.g_owner), count(c.p_owner), total, count(c.g_owner[c.coverage >= FULL]), count(c.g_owner[c.coverage <= 0]), count(c.p_owner[c.outside]))

    rows = _by_batch(gt, pred, margin, keys, "n_gt bigint, n_pred bigint, total double, n_full bigint, n_uncovered bigint, n_outside bigint", make)
    return rows.select(*keys, "n_gt", "n_pred", "total", G.safe_div(F.col("total"), F.col("n_gt")).alias("coverage"), "n_full", "n_uncovered", "n_outside")


def summary(images: DataFrame, *keys: str) -> DataFrame:
    """Micro-averages over the rows of :func:`per_image`."""
    sums = images.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("n_gt", "n_pred", "total", "n_full", "n_uncovered", "n_outside")))
    return sums.select(*keys, "n_gt", "n_pred", "n_full", "n_uncovered", "n_outside", F.round(G.safe_div(F.col("total"), F.col("n_gt")), 6).alias("coverage"),
        F.round(G.safe_div(F.col("n_full"), F.col("n_gt")), 6).alias("full_rate"), F.round(G.safe_div(F.col("n_outside"), F.col("n_pred")), 6).alias("outside_rate"))


def central(pred: DataFrame, axis_x: float = 0.45, axis_y: float = 0.35) -> DataFrame:
    """Predictions that touch the central ellipse of an image of known size."""
    return pred.filter(F.col("w").isNotNull() & (F.col("w") > 0)).filter(G.touches_center_ellipse(F.col("r"), F.col("w").cast("double"), F.col("h").cast("double"), axis_x, axis_y))


def histogram(values: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """bin, n over [0, 1] with the last bin closed; empty bins are listed."""
    low = sum((F.col(column) >= F.lit(i / bins)).cast("int") for i in range(1, bins))
    counts = values.filter(F.col(column).between(0.0, 1.0)).groupBy(low.cast("long").alias("bin")).agg(F.count("*").alias("n"))
    every = values.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return every.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def degree_histogram(values: DataFrame, column: str) -> DataFrame:
    """bin, n: absolute degrees in steps of one."""
    return values.groupBy(F.floor(F.abs(F.col(column))).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def by_stem(preds: DataFrame, append: bool = True) -> DataFrame:
    """stem, boxes: boxes of records with one stem, appended in order; or those of the last record alone."""
    if append:
        ordered = F.array_sort(F.collect_list(F.struct("pos", "boxes")))
        return preds.groupBy("stem").agg(F.flatten(F.transform(ordered, lambda r: r["boxes"])).alias("boxes"))
    return preds.groupBy("stem").agg(F.max_by("boxes", "pos").alias("boxes"))
