"""Small masks as arrays, in Catalyst expressions: no pixel leaves its row, so only grouping masks shuffles.

A mask is ``array<boolean>`` in row-major order with its width. Neighbours outside the grid are ignored: the border
neither erodes nor dilates. Full-size images go through :mod:`veilgrid.operators.pixels`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from .cluster import components
from .pixels import open_mask


def threshold(values: Column, least: float) -> Column:
    return F.transform(values, lambda v: v.cast("double") > least)


def _places(mask: Column) -> Column:
    return F.sequence(F.lit(0), F.size(mask) - 1)


def _along(mask: Column, width: int, reach: int, rows: bool, every: bool) -> Column:
    """For each pixel whether all (or any) of its neighbours in its row, or column, up to ``reach`` away are on; those off the
    grid are left out."""

    def around(k: Column) -> Column:
        place, most, step = (k % width, F.lit(width), 1) if rows else (F.floor(k / width).cast("int"), F.floor(F.size(mask) / width).cast("int"), width)
        out = F.get(mask, k)
        for d in range(1, reach + 1):
            for inside, at in ((place >= d, k - d * step), (place + d < most, k + d * step)):
                near = F.when(inside, F.get(mask, at)).otherwise(every)
                out = out & near if every else out | near
        return out

    return F.transform(_places(mask), around)


def erode(mask: Column, width: int, reach: int = 1) -> Column:
    """A square is a row of rows, so rows and columns are taken one after the other."""
    return _along(_along(mask, width, reach, True, True), width, reach, False, True)


def dilate(mask: Column, width: int, reach: int = 1) -> Column:
    return _along(_along(mask, width, reach, True, False), width, reach, False, False)


def opened(masks: DataFrame, kernel: int, iterations: int, mask: str = "mask", width: str = "width") -> DataFrame:
    """``masks`` with their masks opened, whatever their size: rows of one shape are cleaned together, by integral images, whose
    work does not depend on the size of the kernel."""
    at = masks.columns.index(mask), masks.columns.index(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cleaned = []
            for cells, w in zip(batch.column(at[0]), batch.column(at[1]).to_pylist(), strict=True):
                on = cells.values.to_numpy(zero_copy_only=False).reshape(-1, w)
                cleaned.append(open_mask(np.where(on, 255, 0).astype(np.uint8), kernel, iterations).ravel() > 0)
            ends = np.cumsum([0, *map(len, cleaned)])
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(cleaned) if cleaned else np.zeros(0, bool)))
            yield batch.set_column(at[0], mask, column)

    return masks.mapInArrow(run, masks.schema)


def on_pixels(mask: Column, width: int) -> Column:
    """array<struct<y,x>> of the pixels that are on."""
    cells = F.transform(mask, lambda v, k: F.struct(v.alias("on"), F.floor(k / width).cast("int").alias("y"), (k % width).cast("int").alias("x")))
    return F.transform(F.filter(cells, lambda c: c["on"]), lambda c: F.struct(c["y"].alias("y"), c["x"].alias("x")))


def bounds(pixels: Column) -> Column:
    """Box around pixels; null for none."""
    ys, xs = F.transform(pixels, lambda p: p["y"]), F.transform(pixels, lambda p: p["x"])
    x, y = F.array_min(xs), F.array_min(ys)
    return F.when(F.size(pixels) > 0, G.box(x, y, F.array_max(xs) - x + 1, F.array_max(ys) - y + 1))


def component_boxes(mask: Column, width: int) -> Column:
    """array<struct<n,box>> of the 8-connected components."""
    pixels = F.transform(on_pixels(mask, width), lambda p: F.struct(p["y"].alias("y"), p["x"].alias("x")))
    groups = components(pixels, lambda a, b: (F.abs(a["y"] - b["y"]) <= 1) & (F.abs(a["x"] - b["x"]) <= 1), "struct<y:int,x:int>")
    return F.transform(groups, lambda g: F.struct(F.size(g).alias("n"), bounds(g).alias("box")))


def from_boxes(boxes: Column, width: int, height: int) -> Column:
    """Pixels within any box, clamped; the far edges are inclusive."""
    inside = lambda k: F.exists(boxes, lambda b: ((k % width) >= b["x"]) & ((k % width) <= b["x"] + b["w"]) & (F.floor(k / width) >= b["y"]) & (F.floor(k / width) <= b["y"] + b["h"]))
    return F.transform(F.sequence(F.lit(0), F.lit(width * height - 1)), inside)


def combine(masks: DataFrame, key: str, mask: str = "mask") -> DataFrame:
    """key, mask: on where any mask of the key is. Pre-aggregated per task: one row per key and pixel at most."""
    pixels = masks.select(key, F.posexplode(mask).alias("k", "on")).groupBy(key, "k").agg(F.max("on").alias("on"))
    ordered = F.array_sort(F.collect_list(F.struct("k", "on")))
    return pixels.groupBy(key).agg(F.transform(ordered, lambda p: p["on"]).alias(mask))


def alarm(boxes: DataFrame, ratio: float, key: str = "img_id") -> DataFrame:
    """key, n_large, triggered: more than one box of at least ``ratio`` of the image. boxes: key, r, w, h."""
    large = F.count_if(G.rect_area(F.col("r")) >= F.lit(ratio) * (F.col("w") * F.col("h")).cast("double"))
    return boxes.groupBy(key).agg(large.alias("n_large")).select(key, "n_large", (F.col("n_large") > 1).alias("triggered"))
