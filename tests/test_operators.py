"""Rules checked on literals: rounding, clamping, decoding, folding, joins of records."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from veilgrid.functions import geometry as G
from veilgrid.functions import paths as P
from veilgrid.operators import cluster, evaluate, masks, records
from veilgrid.operators.detections import Params


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def lit_rect(*v):
    return G.rect(*map(F.lit, map(float, v)))


def test_rounding_is_half_to_even(spark):
    r = one(spark, a=G.half_even(F.lit(2.5)), b=G.half_even(F.lit(3.5)), c=G.half_even(F.lit(-0.5)))
    assert (r.a, r.b, r.c) == (2, 4, 0)


@pytest.mark.parametrize(("payload", "want"), [("[1,2,3,4]", (1, 2, 4, 6)), ("[[1,2],[3,4]]", (1, 2, 3, 4)), ("[5,6,0,4]", None), ('[1,2,"z",4]', None), ("{}", None), ("[[1,2]]", None), ("broken", None), ("[]", None)])
def test_box_payloads(spark, payload, want):
    r = one(spark, r=G.box_payload(F.lit(payload))).r
    assert (tuple(r) if r else None) == want


def test_boxes_are_sorted_and_sound(spark):
    raw = F.array(*[F.array(*map(F.lit, b)) for b in ([0.0, 0.0, 2.0, 2.0], [1.0, 1.0, 4.0, 1.0], [9.0, 9.0, 0.0, 5.0], [5.5, 6.5, 3.0, 3.0])])
    assert [tuple(b) for b in one(spark, b=G.deserialize_boxes(raw)).b] == [(6, 6, 3, 3), (0, 0, 2, 2), (1, 1, 4, 1)]


def test_clamping(spark):
    w, h = F.lit(100), F.lit(50)
    r = one(
        spark, inside=G.pad_and_clamp(lit_rect(5, 5, 20, 20), 10, w, h), gone=G.pad_and_clamp(lit_rect(200, 5, 220, 20), 10, w, h), edge=G.pad_and_clamp(lit_rect(90, 40, 99, 49), 3, w, h),
        mixed=G.xyxy_to_clamped_box(*map(F.lit, (30.0, 60.0, -5.0, 10.0)), w, h), free=G.pad_at_origin(lit_rect(1, 1, 99, 49)), drawn=G.draw_clamp(lit_rect(-3, 2.5, 120, 60), w, h),
    )
    assert (tuple(r.inside), r.gone, tuple(r.edge), tuple(r.mixed)) == ((0, 0, 30, 30), None, (87, 37, 13, 13), (0, 10, 30, 40))
    assert tuple(r.free) == (0, 0, 102, 52) and tuple(r.drawn) == (0, 2, 99, 49)


def test_area_limit_is_strict_and_the_ellipse_is_closed(spark):
    w, h = F.lit(100.0), F.lit(100.0)
    r = one(
        spark, at=G.within_area(lit_rect(0, 0, 10, 10), 100.0), over=G.within_area(lit_rect(0, 0, 10, 11), 100.0), free=G.within_area(lit_rect(0, 0, 99, 99), None),
        edge=G.touches_center_ellipse(lit_rect(0, 50, 15, 60), w, h, 0.35, 0.25), off=G.touches_center_ellipse(lit_rect(0, 50, 14, 60), w, h, 0.35, 0.25),
    )
    assert (r["at"], r.over, r.free, r.edge, r.off) == (True, False, True, True, False)


def test_closeness_is_inclusive_on_both_axes(spark):
    a = lit_rect(0, 0, 10, 10)
    got = one(spark, t=G.rects_are_close(a, lit_rect(20, 20, 30, 30), 10.0), f=G.rects_are_close(a, lit_rect(20, 20.5, 30, 30), 10.0))
    assert (got.t, got.f) == (True, False)


def test_rotation(spark):
    quad = lambda *p: F.array(*[F.array(F.lit(float(x)), F.lit(float(y))) for x, y in p])
    r = one(spark, flat=G.rotation_to_zero(quad((0, 0), (10, 0), (10, 2), (0, 2))), tilted=G.rotation_to_zero(quad((0, 0), (10, 10), (9, 11), (-1, 1))), steep=G.rotation_to_zero(quad((0, 0), (1, 10), (0, 10), (-1, 0))))
    assert r.flat == 0 and r.tilted == pytest.approx(-45) and r.steep == pytest.approx(5.710593, abs=1e-5)


@pytest.mark.parametrize(("path", "stem", "suffix"), [("d/a.b.png", "a.b", "png"), (".hid", ".hid", ""), ("x", "x", ""), ("q/x.", "x.", ""), ("..a.PNG", "..a", "png"), ("a/b.tar.GZ", "b.tar", "gz")])
def test_paths(spark, path, stem, suffix):
    r = one(spark, a=P.stem(F.lit(path)), b=P.suffix(F.lit(path)))
    assert (r.a, r.b) == (stem, suffix)


def test_orders_of_paths_differ(spark):
    names = spark.createDataFrame([("a/b",), ("a-b/x",)], "name string")
    assert [r.name for r in names.orderBy(P.parts(F.col("name"))).collect()] == ["a/b", "a-b/x"]
    assert [r.name for r in names.orderBy("name").collect()] == ["a-b/x", "a/b"]


@pytest.mark.parametrize(("reply", "want"), [('```json\n{"a":1}\n```', '{"a":1}'), ('well {"a":{"b":2}} ok', '{"a":{"b":2}}'), ('{"a":', '{"detections":[]}'), ("none", '{"detections":[]}'), ("", '{"detections":[]}')])
def test_replies(spark, reply, want):
    assert one(spark, j=P.extract_json(F.lit(reply))).j == want


def test_small_texts(spark):
    r = one(
        spark, cell=P.latex_number(F.lit(1.5)), none=P.latex_number(F.lit(None).cast("double")), joined=P.joined_text(F.array(F.lit(" a "), F.lit("  "), F.lit("b"))), raw=P.joined_text(F.array(F.lit(" a "), F.lit(" ")), strip=False),
        url=P.data_url(F.lit(b"x" * 100), F.lit("q.TIF")), model=P.model_file_name(F.lit("a/b")), out=P.output_path(F.lit("r/d/x.png"), F.lit("r"), F.lit("o")), file=P.output_path(F.lit("x.png"), F.lit(None).cast("string"), F.lit("o.bmp")),
    )
    assert (r.cell, r.none, r.joined, r.raw, r.model, r.out, r.file) == ("1{,}500", "--", "a | b", " a ", "a_b", "o/d/x.png", "o.bmp")
    assert r.url.startswith("data:image/tiff;base64,") and "\n" not in r.url


def brute_merge(rects, distance):
    groups = []
    for r in rects:
        close = [g for g in groups if any(m[0] - r[2] <= distance and r[0] - m[2] <= distance and m[1] - r[3] <= distance and r[1] - m[3] <= distance for m in g)]
        groups = [g for g in groups if g not in close] + [[x for g in close for x in g] + [r]]
    return sorted((min(m[0] for m in g), min(m[1] for m in g), max(m[2] for m in g), max(m[3] for m in g)) for g in groups)


@pytest.mark.parametrize("seed", range(4))
def test_merge_ignores_order_and_equals_brute_force(spark, seed):
    r = random.Random(seed)
    rects = [(x := r.randint(0, 200), y := r.randint(0, 100), x + r.randint(1, 30), y + r.randint(1, 12)) for _ in range(25)]
    results = []
    for order in (rects, rects[::-1]):
        dets = spark.createDataFrame([(1, k, *map(float, q), f"t{k}", 0.5) for k, q in enumerate(order)], "img_id int, ix long, x1 double, y1 double, x2 double, y2 double, text string, conf double")
        dets = dets.withColumn("r", G.rect(*map(F.col, ("x1", "y1", "x2", "y2"))))
        results.append(sorted(tuple(map(int, m.r)) for m in cluster.merge_close_detections(dets, 6.0, "img_id").collect()))
    assert results[0] == results[1] == brute_merge(rects, 6)


def test_merged_text_is_in_index_order(spark):
    dets = spark.createDataFrame([(1, 2, " c "), (1, 0, "a"), (1, 1, "  ")], "img_id int, ix long, text string").withColumn("r", lit_rect(0, 0, 1, 1)).withColumn("conf", F.col("ix") / 10.0)
    m = cluster.merge_close_detections(dets, 1.0, "img_id").first()
    assert (m.text, m.conf, m.n, m.pos) == ("a | c", 0.2, 3, 0)


def test_evaluation_of_corner_cases(spark):
    schema = "img_id int, ix int, x1 double, y1 double, x2 double, y2 double"
    rect = G.rect(*map(F.col, ("x1", "y1", "x2", "y2")))
    gt = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0), (1, 1, 50.0, 50.0, 50.0, 60.0), (2, 0, 0.0, 0.0, 4.0, 4.0)], schema).withColumn("r", rect)
    pred = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 5.0), (1, 1, 15.0, 0.0, 20.0, 5.0), (3, 0, 0.0, 0.0, 1.0, 1.0)], schema).withColumn("r", rect)
    cov = {(r.img_id, r.ix): r.coverage for r in evaluate.best_coverage(gt, pred, 0.0, "img_id").collect()}
    assert cov == {(1, 0): 0.5, (1, 1): 0.0, (2, 0): 0.0}
    assert {(r.img_id, r.ix) for r in evaluate.outside(gt, pred, 5.0, "img_id").collect()} == {(3, 0)}
    assert {(r.img_id, r.ix) for r in evaluate.outside(gt, pred, 4.0, "img_id").collect()} == {(1, 1), (3, 0)}
    per = {r.img_id: r for r in evaluate.per_image(gt, pred, 0.0).collect()}
    assert (per[1].n_uncovered, per[2].n_pred, per[3].n_gt, per[3].n_outside, per[3].coverage) == (1, 0, 0, 1, 0.0)
    wider = {(r.img_id, r.ix): r.coverage for r in evaluate.best_coverage(gt, pred, 3.0, "img_id").collect()}
    assert all(0 <= cov[k] <= wider[k] <= 1 for k in cov)


def test_histogram_closes_its_last_bin(spark):
    values = spark.createDataFrame([(v,) for v in (0.0, 0.05, 0.1, 0.3, 0.999, 1.0)], "c double")
    assert [r.n for r in evaluate.histogram(values, "c").orderBy("bin").collect()] == [2, 1, 0, 1, 0, 0, 0, 0, 0, 2]


def test_last_record_wins(spark):
    log = spark.createDataFrame([(1, "a", "ok"), (2, "a", "skip"), (3, "b", "bad"), (4, " ", "ok"), (5, "c", "ok")], "pos int, relpath string, status string")
    for latest in (records.latest_decisions, records.latest_decisions_by_window):
        assert {(r.relpath, r.status) for r in latest(log).collect()} == {("a", "skip"), ("b", "bad"), ("c", "ok")}
    scans = spark.createDataFrame([("a",), ("b",), ("z",)], "relpath string")
    assert {r.relpath for r in records.pending(scans, log).collect()} == {"a", "z"}


def test_report_keeps_rows_and_takes_the_last_right_record(spark):
    post = spark.createDataFrame([("a", 0.0, 1.0), ("a", None, 2.0), ("b", None, 3.0)], "name string, sam_time double, post_time double")
    sam = spark.createDataFrame([("a", 0, 5.0), ("a", 1, 7.0)], "name string, pos int, sam_time double")
    deid = spark.createDataFrame([("b", 0, 9.0)], "name string, pos int, deid_time double")
    got = sorted((r.name, r.post_time, r.sam_time, r.deid_time) for r in records.report(post, sam, deid).collect())
    assert got == [("a", 1.0, 0.0, 0.0), ("a", 2.0, 7.0, 0.0), ("b", 3.0, 0.0, 9.0)]


def test_scores_by_place(spark):
    boxes = spark.createDataFrame([("x", [1, 2, 3], [0.2, 0.9])], "img string, boxes array<int>, scores array<double>")
    kept = records.zip_scores(boxes, "img").filter(records.score_passes(F.col("score"), 0.5)).collect()
    assert [r.box for r in kept] == [2, 3]


@pytest.mark.parametrize("changes", [{"merge_distance": -1}, {"max_area": 0}, {"axis_x": 0}, {"axis_y": 1.5}, {"padding": -1}, {"proximity": -2}])
def test_parameters_are_checked(changes):
    with pytest.raises(ValueError):
        Params(**changes)


def test_small_masks(spark):
    r = random.Random(1)
    grid = [r.random() < 0.7 for _ in range(30)]
    near = lambda k: [j for j in range(30) if abs(j // 6 - k // 6) <= 1 and abs(j % 6 - k % 6) <= 1]
    m = F.array(*map(F.lit, grid))
    got = one(spark, e=masks.erode(m, 6), d=masks.dilate(m, 6), b=masks.bounds(masks.on_pixels(m, 6)), none=masks.bounds(masks.on_pixels(F.array(F.lit(False)), 6)), f=masks.from_boxes(F.array(G.box(*map(F.lit, (1, 1, 1, 2)))), 6, 5))
    assert got.e == [all(grid[j] for j in near(k)) for k in range(30)]
    assert got.d == [any(grid[j] for j in near(k)) for k in range(30)]
    assert got.none is None and [k for k in range(30) if got.f[k]] == [y * 6 + x for y, x in itertools.product((1, 2, 3), (1, 2))]


@pytest.mark.parametrize(("small", "at_once"), [(64, 1 << 21), (2, 7)])
def test_merge_equals_plain_components(spark, monkeypatch, small, at_once):
    """Images of many sizes through both ways of finding pairs."""
    monkeypatch.setattr(cluster, "SMALL", small)
    monkeypatch.setattr(cluster, "PAIRS_AT_ONCE", at_once)
    r = random.Random(3)
    rows = [(img, ix, float(r.randrange(0, 300)), float(r.randrange(0, 200))) for img in range(12) for ix in range(r.choice((1, 2, 5, 20, 90)))]
    r.shuffle(rows)
    dets = spark.createDataFrame(rows, "img_id long, ix long, x double, y double").select("img_id", "ix", G.rect(F.col("x"), F.col("y"), F.col("x") + 15, F.col("y") + 6).alias("r"), F.concat(F.lit(" t"), "ix", F.lit(" ")).alias("text"), F.lit(None).cast("double").alias("conf"))
    got = {(m.img_id, m.pos): (tuple(m.r), m.text, m.conf, m.n) for m in cluster.merge_close_detections(dets, 4.0, "img_id").collect()}
    want = {}
    for img in range(12):
        boxes = sorted((ix, (x, y, x + 15, y + 6)) for i, ix, x, y in rows if i == img)
        root = {ix: ix for ix, _ in boxes}

        def find(k, root=root):
            while root[k] != k:
                k = root[k]
            return k

        for (i, a), (j, b) in itertools.combinations(boxes, 2):
            if max(b[0] - a[2], a[0] - b[2], b[1] - a[3], a[1] - b[3]) <= 4:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
        groups = {}
        for ix, b in boxes:
            groups.setdefault(find(ix), []).append((ix, b))
        merged = [(min(b[1] for _, b in g), min(b[0] for _, b in g), k, (min(b[0] for _, b in g), min(b[1] for _, b in g), max(b[2] for _, b in g), max(b[3] for _, b in g)), " | ".join(f"t{ix}" for ix, _ in g), len(g)) for k, g in groups.items()]
        for pos, (_, _, _, rect, text, n) in enumerate(sorted(merged)):
            want[(img, pos)] = (rect, text, None, n)
    assert got == want
    near = {(c.img_id, c.i, c.j) for c in cluster.close_pairs(dets, 4.0).collect()}
    assert near == {(img, i, j) for img in range(12) for (i, a), (j, b) in itertools.combinations(sorted((ix, (x, y, x + 15, y + 6)) for k, ix, x, y in rows if k == img), 2) if max(b[0] - a[2], a[0] - b[2], b[1] - a[3], a[1] - b[3]) <= 4}


def test_coverage_in_blocks(spark, monkeypatch):
    r = random.Random(9)
    box = lambda: G.rect(F.col("x"), F.col("y"), F.col("x") + 20, F.col("y") + 8).alias("r")
    table = lambda n: spark.createDataFrame([(r.randrange(5), k, float(r.randrange(100)), float(r.randrange(60))) for k in range(n)], "img_id long, ix long, x double, y double").select("img_id", "ix", box())
    gt, pred = table(30), table(40)
    whole = [sorted(map(tuple, f(gt, pred, 2.0, "img_id").collect())) for f in (evaluate.best_coverage, evaluate.outside, evaluate.per_image)]
    monkeypatch.setattr(evaluate, "PAIRS_AT_ONCE", 3)
    assert whole == [sorted(map(tuple, f(gt, pred, 2.0, "img_id").collect())) for f in (evaluate.best_coverage, evaluate.outside, evaluate.per_image)]
    assert len(whole[0]) == 30


@pytest.mark.parametrize(("width", "height", "kernel", "iterations"), [(8, 8, 3, 1), (37, 23, 5, 2), (301, 211, 9, 5)])
def test_masks_of_any_size_are_opened(spark, width, height, kernel, iterations):
    r = np.random.default_rng(width)
    rows = [(k, (r.random(width * height) < 0.97).tolist(), width) for k in range(3)]
    got = {x.k: x.mask for x in masks.opened(spark.createDataFrame(rows, "k long, mask array<boolean>, width int"), kernel, iterations).collect()}
    for k, mask, _ in rows:
        want = np.array(mask).reshape(height, width)
        reach = iterations * (kernel // 2)
        for off in (True, False):  # erosion is dilation of what is off
            grown = ~want if off else want
            for axis in (0, 1):
                padded = np.pad(grown, [(reach, reach) if a == axis else (0, 0) for a in (0, 1)])
                grown = np.lib.stride_tricks.sliding_window_view(padded, 2 * reach + 1, axis=axis).any(axis=-1)
            want = ~grown if off else grown
        assert got[k] == want.ravel().tolist()


def test_ranks_over_all_rows(spark, monkeypatch):
    monkeypatch.setattr(records, "CUTS", 4)
    names = ["b", "a/z", "a", "", None, "a", "c", "a-b", "d"]
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    ranked = sorted((r["rank"], r.name) for r in records.global_rank(rows, "name", "rank").collect())
    assert ranked == list(zip(range(1, 10), sorted(names, key=lambda n: (n is not None, n or "")), strict=True))
    assert records.global_rank(rows.limit(0), "name", "rank").count() == 0
