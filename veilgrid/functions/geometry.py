"""Boxes, rectangles and quads as Catalyst expressions: every function maps columns to a column, without UDFs.

A *box* is ``struct<x,y,w,h:int>`` (wire form: an array of four), a *rect* is ``struct<x1,y1,x2,y2:double>``, a *quad* is an
array of points. Whole-number rounding is half to even.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<x:int,y:int,w:int,h:int>"
RECT = "struct<x1:double,y1:double,x2:double,y2:double>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(c: Column | str) -> Column:
    return F.rint(_col(c).cast("double")).cast("int")


def rect(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(*(_col(c).cast("double").alias(n) for c, n in zip((x1, y1, x2, y2), ("x1", "y1", "x2", "y2"), strict=True)))


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(*(_col(c).cast("int").alias(n) for c, n in zip((x, y, w, h), ("x", "y", "w", "h"), strict=True)))


def box_area(b: Column | str) -> Column:
    b = _col(b)
    return b["w"].cast("long") * b["h"].cast("long")


def quad_to_rect(quad: Column | str) -> Column:
    """Bounds of the points of a quad, in whatever order they come."""
    xs, ys = F.transform(_col(quad), lambda p: p[0].cast("double")), F.transform(_col(quad), lambda p: p[1].cast("double"))
    return rect(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def rect_to_quad(r: Column | str) -> Column:
    """Clockwise from the top left, rounded."""
    r = _col(r)
    x1, y1, x2, y2 = (half_even(r[n]) for n in ("x1", "y1", "x2", "y2"))
    return F.array(F.array(x1, y1), F.array(x2, y1), F.array(x2, y2), F.array(x1, y2))


def rect_area(r: Column | str) -> Column:
    r = _col(r)
    return F.greatest(F.lit(0.0), r["x2"] - r["x1"]) * F.greatest(F.lit(0.0), r["y2"] - r["y1"])


def xywh_to_rect(b: Column | str) -> Column:
    b = _col(b)
    return rect(b["x"], b["y"], b["x"] + b["w"], b["y"] + b["h"])


def intersection_area(a: Column, b: Column) -> Column:
    width = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    height = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.greatest(F.lit(0.0), width) * F.greatest(F.lit(0.0), height)


def expand_rect(r: Column, margin: float) -> Column:
    return rect(r["x1"] - margin, r["y1"] - margin, r["x2"] + margin, r["y2"] + margin)


def touches(a: Column, b: Column) -> Column:
    """Overlap or contact, edges included."""
    return (a["x1"] <= b["x2"]) & (b["x1"] <= a["x2"]) & (a["y1"] <= b["y2"]) & (b["y1"] <= a["y2"])


def rects_are_close(a: Column, b: Column, distance: Column | float) -> Column:
    """The gap between the rectangles is at most ``distance`` on both axes."""
    return (b["x1"] - a["x2"] <= distance) & (a["x1"] - b["x2"] <= distance) & (b["y1"] - a["y2"] <= distance) & (a["y1"] - b["y2"] <= distance)


def within_area(r: Column, limit: Column | float | None) -> Column:
    """Strict upper limit: a rectangle of exactly the limit stays; no limit keeps all."""
    if limit is None:
        return F.lit(True)
    limit = F.lit(limit) if not isinstance(limit, Column) else limit
    return limit.isNull() | (rect_area(r) <= limit)


def touches_center_ellipse(r: Column, width: Column, height: Column, axis_x: Column | float, axis_y: Column | float, proximity: Column | float = 0.0) -> Column:
    """The point of the rectangle nearest to the image centre lies in the ellipse. Semi-axes are shares of the full sides."""
    cx, cy = width / F.lit(2.0), height / F.lit(2.0)
    a, b = F.greatest(F.lit(1.0), width * axis_x + proximity), F.greatest(F.lit(1.0), height * axis_y + proximity)
    dx = (F.least(F.greatest(cx, r["x1"]), r["x2"]) - cx) / a
    dy = (F.least(F.greatest(cy, r["y1"]), r["y2"]) - cy) / b
    return dx * dx + dy * dy <= 1.0


def center_in_ellipse(r: Column, width: Column, height: Column, share_x: float = 0.78, share_y: float = 0.72) -> Column:
    """The centre of the rectangle lies in an ellipse whose semi-axes are shares of the half sides."""
    dx = ((r["x1"] + r["x2"]) / 2.0 - width / 2.0) / (width / 2.0 * share_x)
    dy = ((r["y1"] + r["y2"]) / 2.0 - height / 2.0) / (height / 2.0 * share_y)
    return dx * dx + dy * dy <= 1.0


def pad_and_clamp(r: Column, padding: Column | int, width: Column, height: Column) -> Column:
    """A box grown by ``padding`` and cut at the image; null where nothing is left."""
    x1, y1 = F.greatest(F.lit(0), half_even(r["x1"]) - padding), F.greatest(F.lit(0), half_even(r["y1"]) - padding)
    x2, y2 = F.least(width.cast("int"), half_even(r["x2"]) + padding), F.least(height.cast("int"), half_even(r["y2"]) + padding)
    return F.when((x2 > x1) & (y2 > y1), box(x1, y1, x2 - x1, y2 - y1))


def pad_at_origin(r: Column, padding: int = 3) -> Column:
    """The older form: the left and upper edges stop at 0, the others run free."""
    x1, y1 = F.greatest(F.lit(0), half_even(r["x1"]) - padding), F.greatest(F.lit(0), half_even(r["y1"]) - padding)
    return box(x1, y1, half_even(r["x2"]) + padding - x1, half_even(r["y2"]) + padding - y1)


def xyxy_to_clamped_box(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """Corners in any order, rounded and cut at the image; null where nothing is left."""
    inside = lambda v, most: F.least(F.greatest(half_even(v), F.lit(0)), most.cast("int"))
    left, right = inside(F.least(x1, x2), width), inside(F.greatest(x1, x2), width)
    top, bottom = inside(F.least(y1, y2), height), inside(F.greatest(y1, y2), height)
    return F.when((right > left) & (bottom > top), box(left, top, right - left, bottom - top))


def by_area(boxes: Column) -> Column:
    """Largest first; equal areas keep their order."""
    ranked = F.transform(boxes, lambda b, k: F.struct((-box_area(b)).alias("key"), k.alias("pos"), b.alias("box")))
    return F.transform(F.array_sort(ranked), lambda r: r["box"])


def deserialize_boxes(raw: Column) -> Column:
    """Arrays of four numbers as boxes: others and boxes without area go, largest first."""
    four = F.filter(raw, lambda v: v.isNotNull() & (F.size(v) == 4) & ~F.exists(v, lambda e: e.isNull()))
    boxes = F.transform(four, lambda v: box(*(half_even(v[k]) for k in range(4))))
    return by_area(F.filter(boxes, lambda b: (b["w"] > 0) & (b["h"] > 0)))


def parse_detections(raw: Column) -> Column:
    """Readings with at least four points, points rounded, text and probability cast."""
    whole = F.filter(raw, lambda d: d["quad"].isNotNull() & (F.size(d["quad"]) >= 4))
    return F.transform(
        whole, lambda d: F.struct(F.transform(d["quad"], lambda p: F.transform(p, half_even)).alias("quad"), d["text"].cast("string").alias("text"), d["prob"].cast("double").alias("prob"))
    )


def box_payload(payload: Column) -> Column:
    """Rect of a JSON payload: four numbers are x, y, w, h, points give their bounds; anything else is null."""
    parsed = F.try_parse_json(payload)
    numbers = F.try_variant_get(parsed, "$", "array<double>")
    points = F.try_variant_get(parsed, "$", "array<array<double>>")
    sound = lambda a: ~F.exists(a, lambda e: e.isNull())
    flat = F.when((F.size(numbers) == 4) & sound(numbers) & (numbers[2] > 0) & (numbers[3] > 0), rect(numbers[0], numbers[1], numbers[0] + numbers[2], numbers[1] + numbers[3]))
    shaped = F.when((F.size(points) >= 2) & ~F.exists(points, lambda p: p.isNull() | (F.size(p) < 2)), quad_to_rect(points))
    return F.coalesce(flat, shaped)


def spelled_boxes(detections: Column) -> Column:
    """Boxes of model answers {text, bbox:[x,y,w,h]}: rounded, with area, each with its text."""
    full = F.filter(detections, lambda d: d["bbox"].isNotNull() & (F.size(d["bbox"]) == 4))
    rounded = F.transform(full, lambda d: F.struct(*(half_even(d["bbox"][k]).alias(n) for k, n in enumerate("xywh")), F.coalesce(d["text"], F.lit("")).alias("text")))
    return F.filter(rounded, lambda b: (b["w"] > 0) & (b["h"] > 0))


def paddle_boxes(reply: Column) -> Column:
    """Boxes of a reader's JSON reply, a list of lines [quad, [text, confidence]] or a list that holds one such list: bounds cut to
    whole numbers; lines without a sound quad and quads without area go."""
    parsed = F.try_parse_json(reply)
    outer = F.try_variant_get(parsed, "$", "array<variant>")
    inner = F.try_variant_get(parsed, "$[0]", "array<variant>")
    lines = F.coalesce(F.when((F.size(outer) == 1) & inner.isNotNull(), inner).otherwise(outer), F.array().cast("array<variant>"))
    quads = F.transform(lines, lambda line: F.try_variant_get(line, "$[0]", "array<array<double>>"))
    sound = F.filter(quads, lambda q: q.isNotNull() & (F.size(q) > 0) & ~F.exists(q, lambda p: p.isNull() | (F.size(p) < 2) | F.get(p, F.lit(0)).isNull() | F.get(p, F.lit(1)).isNull()))
    sized = F.filter(F.transform(sound, quad_to_rect), lambda r: (r["x2"] > r["x1"]) & (r["y2"] > r["y1"]))
    return F.transform(sized, lambda r: box(r["x1"], r["y1"], r["x2"] - r["x1"], r["y2"] - r["y1"]))


def rotation_to_zero(quad: Column | str) -> Column:
    """Degrees that bring the longest edge (the first of equals) to the nearest axis, in [-45, 45]."""

    def longest_edge(q: Column) -> Column:
        edges = [F.struct((q[(k + 1) % 4][0] - q[k][0]).cast("double").alias("dx"), (q[(k + 1) % 4][1] - q[k][1]).cast("double").alias("dy")) for k in range(4)]
        size = lambda e: e["dx"] * e["dx"] + e["dy"] * e["dy"]
        return F.aggregate(F.array(*edges[1:]), edges[0], lambda best, e: F.when(size(e) > size(best), e).otherwise(best))

    wrapped = lambda a: F.when(a > 90.0, a - 180.0).when(a <= -90.0, a + 180.0).otherwise(a)
    turn = lambda a: F.when(a > 45.0, 90.0 - a).when(a < -45.0, -90.0 - a).otherwise(-a)
    edge = _bind(_col(quad), longest_edge)
    return _bind(_bind(_bind(edge, lambda e: F.degrees(F.atan2(e["dy"], e["dx"]))), wrapped), turn)


def _bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once, however often f names it."""
    return F.transform(F.array(value), lambda v: f(v))[0]


def rotate_point(x: Column, y: Column, cx: Column, cy: Column, degrees: Column) -> Column:
    """A point turned about a centre in image coordinates (y downwards)."""
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    return F.struct((c * (x - cx) + s * (y - cy) + cx).alias("x"), (-s * (x - cx) + c * (y - cy) + cy).alias("y"))


def blur_roi(r: Column, width: Column, height: Column, pad: int = 12, least_kernel: int = 31) -> Column:
    """Region to blur and the odd size of its kernel."""
    x1, y1 = F.greatest(F.lit(0), half_even(r["x1"]) - pad), F.greatest(F.lit(0), half_even(r["y1"]) - pad)
    x2, y2 = F.least(width.cast("int"), half_even(r["x2"]) + pad), F.least(height.cast("int"), half_even(r["y2"]) + pad)
    side = F.greatest(y2 - y1, x2 - x1)
    kernel = F.greatest(F.lit(least_kernel), F.floor(side / 2).cast("int").bitwiseOR(F.lit(1)))
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), kernel.alias("kernel"))


def draw_clamp(r: Column, width: Column, height: Column) -> Column:
    """Corners for drawing: rounded and kept on the image's own pixels."""
    at = lambda v, most: F.least(F.greatest(half_even(v), F.lit(0)), most.cast("int") - 1)
    return F.struct(at(r["x1"], width).alias("x1"), at(r["y1"], height).alias("y1"), at(r["x2"], width).alias("x2"), at(r["y2"], height).alias("y2"))


def safe_div(n: Column, d: Column) -> Column:
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))


def fit_scale(width: Column, height: Column, most_width: int = 1500, most_height: int = 900) -> Column:
    return F.least(F.lit(float(most_width)) / width, F.lit(float(most_height)) / height, F.lit(1.0))
