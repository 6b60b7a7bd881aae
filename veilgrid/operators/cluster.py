"""Close rectangles within an image: pairs, and their transitive closure merged into enclosing rectangles.

The detections of an image are gathered once, by one shuffle, and an Arrow batch of many images is merged at a time: numpy
compares the rectangles of each image, labels spread along the links until they are stable, and the groups are reduced. Edges run
between members, never between merged boxes, so the components are exact. There is no iteration over the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import geometry as G

#: Up to so many detections of an image all pairs are compared; beyond, only those whose x ranges come near each other, so
#: many pairs at a time.
SMALL, PAIRS_AT_ONCE = 64, 1 << 21


def close_pairs(dets: DataFrame, distance: float, key: str = "img_id") -> DataFrame:
    """key, i < j: pairs of detections of one image at most ``distance`` apart. dets: key, ix, r."""
    item = F.struct(F.col("ix").cast("bigint").alias("ix"), F.col("r"))
    gathered = dets.groupBy(key).agg(F.collect_list(item).alias("dets"))
    schema = StructType([gathered.schema[key], *StructType.fromDDL("i bigint, j bigint").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = Detections(batch.column(1))
            for a, b, gap in d.near(distance):
                close = (gap <= distance) & (d.ix[a] < d.ix[b])
                a, b = a[close], b[close]
                yield pa.record_batch([batch.column(0).take(pa.array(d.owner[a])), pa.array(d.ix[a]), pa.array(d.ix[b])], names=[key, "i", "j"])

    return gathered.mapInArrow(run, schema)


def components(items: Column, linked: Callable[[Column, Column], Column], item_type: str) -> Column:
    """Connected components of a short array as an array of arrays, as an expression."""

    def step(groups: Column, item: Column) -> Column:
        meets = lambda g: F.exists(g, lambda m: linked(m, item))
        joined = F.flatten(F.filter(groups, meets))
        return F.concat(F.filter(groups, lambda g: ~meets(g)), F.array(F.concat(joined, F.array(item))))

    return F.aggregate(items, F.array().cast(f"array<array<{item_type}>>"), step)


class Detections:
    """The detections of the images of a batch as flat columns, by image and index. lists: array<struct<ix, r, ...>>."""

    def __init__(self, lists: pa.ListArray) -> None:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        owner = np.repeat(np.arange(len(lists)), sizes)
        ix = flat.field("ix").to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.lexsort((ix, owner))
        self.images, self.sizes = len(lists), sizes
        self.owner, self.ix = owner[order], ix[order]
        self.rows = flat.take(pa.array(order))
        r = self.rows.field("r")
        self.x1, self.y1, self.x2, self.y2 = (r.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x1", "y1", "x2", "y2"))

    def _gap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The largest of the four distances that must not exceed the limit."""
        return np.maximum(np.maximum(self.x1[b] - self.x2[a], self.x1[a] - self.x2[b]), np.maximum(self.y1[b] - self.y2[a], self.y1[a] - self.y2[b]))

    def near(self, distance: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(a, b, gap): pairs of one image, a before b, among them all that are at most ``distance`` apart."""
        starts = np.cumsum(self.sizes) - self.sizes
        left = np.arange(self.owner.size) - starts[self.owner]
        left = self.sizes[self.owner] - left  # members from here to the end of the image
        a = np.flatnonzero((self.sizes[self.owner] <= SMALL) & (left > 1))
        step = 1
        while a.size:
            yield a, a + step, self._gap(a, a + step)
            step += 1
            a = a[left[a] > step]
        for image in np.flatnonzero(self.sizes > SMALL).tolist():
            begin, n = starts[image], self.sizes[image]
            order = begin + np.argsort(self.x1[begin : begin + n], kind="stable")
            reach = np.searchsorted(self.x1[order], self.x2[order] + distance, side="right")
            reach = np.maximum(reach, np.arange(n) + 1)  # a rectangle turned inside out still meets what begins where it does
            counts = reach - np.arange(n) - 1
            at = 0
            while at < n:
                until = max(at + 1, int(np.searchsorted(np.cumsum(counts[at:]), PAIRS_AT_ONCE)) + at)
                some = counts[at:until]
                first = np.repeat(np.arange(at, until), some)
                second = first + 1 + np.arange(first.size) - np.repeat(np.cumsum(some) - some, some)
                one, two = order[first], order[second]
                gap = self._gap(one, two)
                keep = gap <= distance
                one, two = one[keep], two[keep]
                yield np.minimum(one, two), np.maximum(one, two), gap[keep]
                at = until

    def groups(self, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For each detection the first one of its component."""
        lead = np.arange(self.owner.size)
        for a, b in links:
            while True:
                x, y = lead[a], lead[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(lead, np.maximum(x, y), np.minimum(x, y))
                while (again := lead[lead])[lead != again].size:
                    lead = again
        return lead


class Merged:
    """Groups of detections, reduced: their image, rectangle, smallest index, size and members, in the final order."""

    def __init__(self, d: Detections, lead: np.ndarray, among: np.ndarray | None = None) -> None:
        members = np.arange(lead.size) if among is None else np.flatnonzero(among)
        members = members[np.argsort(lead[members], kind="stable")]  # by group, in order of the index
        starts = np.flatnonzero(np.diff(lead[members], prepend=-1))
        low = lambda v: np.minimum.reduceat(v[members], starts) if starts.size else v[:0]
        high = lambda v: np.maximum.reduceat(v[members], starts) if starts.size else v[:0]
        x1, y1, x2, y2 = low(d.x1), low(d.y1), high(d.x2), high(d.y2)
        heads = members[starts]
        self.order = np.lexsort((d.ix[heads], x1, y1, d.owner[heads]))
        self.members, self.starts = members, starts
        self.owner = d.owner[heads][self.order]
        self.x1, self.y1, self.x2, self.y2 = (v[self.order] for v in (x1, y1, x2, y2))
        self.n = np.diff(np.append(starts, members.size))[self.order]
        first = np.flatnonzero(np.diff(self.owner, prepend=-1))
        self.pos = np.arange(self.owner.size) - np.repeat(first, np.diff(np.append(first, self.owner.size)))

    def texts(self, d: Detections, strip: bool) -> pa.Array:
        """The texts of each group in order, joined by a bar; blank ones are left out."""
        texts = d.rows.field("text").take(pa.array(self.members))
        stripped = pc.utf8_trim(texts, " ")
        kept = pc.fill_null(pc.not_equal(stripped, ""), False)
        before = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
        lists = pa.ListArray.from_arrays(pa.array(before[np.append(self.starts, self.members.size)], pa.int32()), (stripped if strip else texts).filter(kept))
        return pc.binary_join(lists, " | ").take(pa.array(self.order))

    def conf(self, d: Detections) -> pa.Array:
        """The largest confidence of each group; null where none is known."""
        values = d.rows.field("conf").take(pa.array(self.members))
        known = values.is_valid().to_numpy(zero_copy_only=False)
        filled = np.where(known, values.to_numpy(zero_copy_only=False).astype(float), -np.inf)
        if not self.starts.size:
            return pa.array([], pa.float64())
        best, some = np.maximum.reduceat(filled, self.starts), np.logical_or.reduceat(known, self.starts)
        return pa.array(best[self.order], mask=~some[self.order])


def rects(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(map(pa.array, (x1, y1, x2, y2))), names=["x1", "y1", "x2", "y2"])


def gather(dets: DataFrame, *keys: str) -> DataFrame:
    """keys, dets: the detections of each image as one array."""
    item = F.struct(F.col("ix").cast("bigint").alias("ix"), F.col("r"), F.col("text"), F.col("conf").cast("double").alias("conf"))
    return dets.groupBy(*keys).agg(F.collect_list(item).alias("dets"))


def merge_close_detections(dets: DataFrame, distance: float, *keys: str, strip: bool = True) -> DataFrame:
    """keys, pos, r, text, conf, n: a row for each merged detection, by (y1, x1, smallest index)."""
    gathered = gather(dets, *keys)
    schema = StructType([*(gathered.schema[k] for k in keys), *StructType.fromDDL(f"pos int, r {G.RECT}, text string, conf double, n int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = Detections(batch.column(len(keys)))
            m = Merged(d, d.groups((a[gap <= distance], b[gap <= distance]) for a, b, gap in d.near(distance)))
            own = [batch.column(k).take(pa.array(m.owner)) for k in range(len(keys))]
            yield pa.record_batch([*own, pa.array(m.pos, pa.int32()), rects(m.x1, m.y1, m.x2, m.y2), m.texts(d, strip), m.conf(d), pa.array(m.n, pa.int32())], names=schema.names)

    return gathered.mapInArrow(run, schema)


def merged_sweep(gathered: DataFrame, grid: list[dict], key: str) -> DataFrame:
    """param, value, key, r, w, h for each row of a grid: what is left of the detections of each image after the row's filter,
    merge, padding and clamping. The distances within an image are taken once for all rows. gathered: key, w, h, dets."""
    fields = StructType.fromDDL(f"r {G.RECT}, w bigint, h bigint").fields
    schema = StructType([*StructType.fromDDL("param string, value string").fields, gathered.schema[key], *fields])
    widest = max((row["merge_distance"] for row in grid), default=0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = Detections(batch.column(3))
            links = [(a[gap <= widest], b[gap <= widest], gap[gap <= widest]) for a, b, gap in d.near(widest)]
            w, h = (batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in (1, 2))
            area = np.maximum(0.0, d.x2 - d.x1) * np.maximum(0.0, d.y2 - d.y1)
            cx, cy = w[d.owner] / 2.0, h[d.owner] / 2.0
            for row in grid:
                dx = (np.minimum(np.maximum(cx, d.x1), d.x2) - cx) / np.maximum(1.0, w[d.owner] * row["axis_x"])
                dy = (np.minimum(np.maximum(cy, d.y1), d.y2) - cy) / np.maximum(1.0, h[d.owner] * row["axis_y"])
                kept = dx * dx + dy * dy > 1.0
                if row["max_area"] is not None:
                    kept &= area <= row["max_area"]
                chosen = ((gap <= row["merge_distance"]) & kept[a] & kept[b] for a, b, gap in links)
                m = Merged(d, d.groups((a[c], b[c]) for (a, b, _), c in zip(links, chosen, strict=True)), kept)
                x1, y1 = (np.maximum(0, np.rint(v) - row["padding"]) for v in (m.x1, m.y1))
                x2, y2 = (np.minimum(most[m.owner], np.rint(v) + row["padding"]) for v, most in ((m.x2, w), (m.y2, h)))
                left = np.flatnonzero((x2 > x1) & (y2 > y1))
                of = pa.array(m.owner[left])
                named = [pa.array([row[c]] * left.size, pa.string()) for c in ("param", "value")]
                yield pa.record_batch([*named, batch.column(0).take(of), rects(x1[left], y1[left], x2[left], y2[left]), *(batch.column(k).take(of).cast(pa.int64()) for k in (1, 2))], names=schema.names)

    return gathered.mapInArrow(run, schema)
