"""The redaction decision: which text boxes of an image are painted over."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from .cluster import gather, merge_close_detections, merged_sweep


@dataclass(frozen=True)
class Params:
    merge_distance: float = 10.0
    max_area: float | None = None
    axis_x: float = 0.35
    axis_y: float = 0.25
    proximity: float = 0.0
    padding: int = 3

    def __post_init__(self) -> None:
        if self.merge_distance < 0 or self.padding < 0 or self.proximity < 0:
            raise ValueError("distances must not be negative")
        if self.max_area is not None and self.max_area <= 0:
            raise ValueError("max_area must be positive or None")
        if not (0 < self.axis_x <= 1 and 0 < self.axis_y <= 1):
            raise ValueError("ellipse axes must be in (0, 1]")

    def with_(self, **changes) -> Params:
        return replace(self, **changes)


#: The shipped settings, with an area limit at which the derived boxes are filtered too.
SHIPPED = Params(10.0, 120000.0, 0.45, 0.35, 0.0, 10)


def kept(r: Column, w: Column, h: Column, p: Params) -> Column:
    """Not too large, and clear of the central ellipse, where the teeth are."""
    return G.within_area(r, p.max_area) & ~G.touches_center_ellipse(r, w.cast("double"), h.cast("double"), p.axis_x, p.axis_y, p.proximity)


def filter_detections(dets: DataFrame, p: Params) -> DataFrame:
    return dets.filter(kept(F.col("r"), F.col("w"), F.col("h"), p))


def redaction_boxes(dets: DataFrame, p: Params, key: str = "img_id") -> DataFrame:
    """Filter, merge, pad and clamp, in this order; merged boxes are not filtered again. key, pos, x, y, w, h, text, conf, n."""
    merged = merge_close_detections(filter_detections(dets, p), p.merge_distance, key, "w", "h")
    padded = merged.withColumn("b", G.pad_and_clamp(F.col("r"), p.padding, F.col("w"), F.col("h"))).filter("b is not null")
    return padded.select(key, "pos", "b.x", "b.y", F.col("b.w").alias("bw"), F.col("b.h").alias("bh"), "text", "conf", "n")


def sweep(dets: DataFrame, grid: DataFrame, key: str = "img_id") -> DataFrame:
    """Redaction rects of every parameter row of a small grid: param, value, key, r (padded), w, h.

    The readings are gathered once by image and meet all rows of the grid there; the grid, a literal of a few rows, goes
    with the function that merges them.
    """
    rows = [r.asDict() for r in grid.collect()]
    return merged_sweep(gather(dets, key, "w", "h"), rows, key)
