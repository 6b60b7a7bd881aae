"""Pixel kernels against plain loops, images through Spark's own reader, stages end to end, streams."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from veilgrid.functions import paths
from veilgrid.operators import models, pixels
from veilgrid.plans import events, runners, stages
from veilgrid.sources import config, images, records, schemas
from veilgrid.streaming import ingest

RNG = np.random.default_rng(5)


def noisy(h=23, w=31, share=0.6):
    return np.where(RNG.random((h, w)) < share, 255, 0).astype(np.uint8)


@pytest.mark.parametrize(("kernel", "iterations"), [(3, 1), (3, 2), (5, 1)])
def test_opening_equals_repeated_erosion_and_dilation(kernel, iterations):
    mask = noisy(share=0.9)
    want = mask > 0
    r = kernel // 2
    for step in (all, any):
        for _ in range(iterations):
            want = np.array([[step(want[max(0, y - r) : y + r + 1, max(0, x - r) : x + r + 1].ravel()) for x in range(want.shape[1])] for y in range(want.shape[0])])
    got = pixels.open_mask(mask, kernel, iterations)
    assert ((got > 0) == want).all() and not ((got > 0) & (mask == 0)).any()
    assert (pixels.open_mask(got, kernel, iterations) == got).all()


def test_labels_equal_flood_fill():
    on = noisy(share=0.45) > 0
    labels, n = pixels.label(on)
    seen = np.zeros_like(on)
    groups = 0
    for y, x in np.argwhere(on):
        if seen[y, x]:
            continue
        groups += 1
        stack, found = [(y, x)], []
        seen[y, x] = True
        while stack:
            a, b = stack.pop()
            found.append(labels[a, b])
            for c in range(max(0, a - 1), min(on.shape[0], a + 2)):
                for d in range(max(0, b - 1), min(on.shape[1], b + 2)):
                    if on[c, d] and not seen[c, d]:
                        seen[c, d] = True
                        stack.append((c, d))
        assert len(set(found)) == 1
    assert groups == n and (labels > 0).tolist() == on.tolist()


def test_components_in_holes_are_left_out():
    mask = np.zeros((12, 12), np.uint8)
    mask[1:11, 1:11], mask[3:9, 3:9], mask[5:7, 5:7] = 255, 0, 255
    assert pixels.extract_boxes(mask) == [(1, 1, 10, 10)]


@pytest.mark.parametrize("angle", [0, 20, -35, 60])
def test_smallest_rectangle_of_a_turned_rectangle(angle):
    want = ((60.0, 50.0), (60.0, 24.0), float(angle))
    inside = np.argwhere(pixels.inside_polygon((110, 120), pixels.corners(want)))[:, ::-1]
    center, size, _ = pixels.min_area_rect(inside)
    assert np.allclose(center, (60, 50), atol=1.5) and np.allclose(sorted(size), (24, 60), atol=2.5)
    fitted = pixels.largest_fitting(np.where(pixels.inside_polygon((110, 120), pixels.corners(want)), 255, 0).astype(np.uint8))
    turn = pixels.rotation_to_zero(fitted)
    assert abs(((angle + turn) + 45) % 90 - 45) < 3 and fitted[1][0] * fitted[1][1] > 0.7 * 60 * 24


def test_rotation_moves_pixels():
    image = np.zeros((41, 41), np.uint8)
    image[20, 30] = 255
    assert np.argwhere(pixels.rotate(image, (20, 20), 90, smooth=False)).tolist() == [[10, 20]]
    flat = np.full((20, 30, 3), 77, np.uint8)
    assert (pixels.rotate(flat, (15, 10), 33, smooth=True) == 77).all()


def test_crop_draw_and_blur():
    image = RNG.integers(0, 255, (30, 40, 3)).astype(np.uint8)
    mask = np.zeros((30, 40), np.uint8)
    assert (pixels.crop(image, mask) == image).all()
    mask[5:9, 7:20] = 1
    assert pixels.crop(image, mask).shape == (4, 13, 3)
    filled = pixels.draw_boxes(image, [(5, 5, 10, 8)], fill=True)
    assert (filled[5:14, 5:16] == (0, 0, 255)).all() and (filled[20:] == image[20:]).all()
    outline = pixels.draw_boxes(image, [(5, 5, 10, 8)])
    assert (outline[9, 10] == image[9, 10]).all() and (outline[5, 5:16] == (0, 0, 255)).all()
    blurred = pixels.blur_region(image, (5, 5, 25, 20), 31)
    assert blurred[5:20, 5:25].std() < image[5:20, 5:25].std() / 2 and (blurred[25:] == image[25:]).all()


def test_mask_stacks():
    for shape in ((2, 1, 4, 5), (2, 4, 5), (4, 5), (4, 5, 2)):
        assert pixels.to_mask_stack(np.ones(shape), (5, 4)).shape[1:] == (4, 5)
    with pytest.raises(ValueError):
        pixels.to_mask_stack(np.ones((3, 3)), (5, 4))
    assert pixels.combine(np.zeros((0, 4, 5)), [(1, 1, 2, 1)], (4, 5)).sum() == 255 * 6


def test_straightening_keeps_the_content():
    image = np.full((60, 80), 250, np.uint8)
    image[20:40, 10:70] = 5
    assert pixels.straighten(image, 31).min() < 50


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    """Scans with a bright subject and two white labels, in folders that sort differently as paths and as text."""
    root = tmp_path_factory.mktemp("scans")
    for name, gray in (("a/x_patient_1.png", False), ("a-b/y_patient_2.PNG", True), ("z.png", False)):
        image = np.zeros((60, 90, 3), np.uint8)
        image[5:55, 5:85] = (90, 100, 110)
        image[8:12, 8:20] = image[46:52, 60:80] = 255
        path = root / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(pixels.encode_png(image[..., 0] if gray else image))
    (root / "broken.png").write_bytes(b"no image")
    (root / "notes.txt").write_text("no image")
    return root


def test_png_round_trip_through_the_image_source(spark, tree):
    rows = {r.name: r for r in images.read_images(spark, str(tree)).collect()}
    assert set(rows) == {"a/x_patient_1.png", "a-b/y_patient_2.PNG", "z.png", "broken.png"} and rows["broken.png"].height == -1
    x = pixels.from_spark_image(*(rows["z.png"][c] for c in ("height", "width", "channels", "data")))
    assert x.shape == (60, 90, 3) and x[30, 30].tolist() == [90, 100, 110]
    with pytest.raises(Exception, match="unreadable"):
        images.read_images(spark, str(tree), invalid="fail").collect()


def test_listing_orders_and_indexes(spark, tree):
    listing = images.scan_names(images.list_files(spark, str(tree)))
    assert [r.name for r in images.in_path_order(listing).collect()][:2] == ["a/x_patient_1.png", "a-b/y_patient_2.PNG"]
    assert [r.name for r in images.in_text_order(listing).collect()][:2] == ["a-b/y_patient_2.PNG", "a/x_patient_1.png"]
    assert images.patient_scans(listing).count() == 2
    assert {r.stem for r in images.index_by_stem(listing).collect()} == {"x_patient_1", "y_patient_2", "z", "broken"}
    with pytest.raises(FileNotFoundError):
        images.require_some(listing.limit(0))


def test_candidates_by_priority(spark):
    row = spark.createDataFrame([("m/d/s_mask.png", "named.png", "root", "m")], "mask string, label_image string, root string, mask_root string")
    c = images.candidate_images(row).first().candidates
    assert c[:3] == ["named.png", "m/d/named.png", "root/named.png"] and c.index("root/d/s.jpg") < c.index("m/d/s.jpg")


SETTINGS = 'output_dir = "out"\noutput_json = "out/report.json"\nkernel_size = 3\niterations = 1\nmax_area = 0\naxis_x = 0.1\naxis_y = 0.1\npadding = 1\n'


def test_stages_end_to_end(spark, tree, tmp_path, caplog):
    text = f'[pipeline]\ninput_path = "{tree}"\nunreadable = "list"\n{SETTINGS}'
    conf = config.parse_config(text, tmp_path)
    running = stages.Run(spark, conf)
    with caplog.at_level("INFO", "veilgrid"):
        out = running()
    assert {r.name for r in out["report"].collect()} == {"a/x_patient_1.png", "a-b/y_patient_2.PNG", "z.png"}
    boxes = {r.name: r.boxes for r in out["deidentification"].collect()}
    assert all(len(b) == 2 for b in boxes.values())
    report = json.loads((tmp_path / "out/report.json").read_text())
    assert [r["name"] for r in report] == sorted(boxes) and all(len(r["deidentification_boxes"]) == 2 for r in report)
    assert all(r["metrics"]["times"][k] > 0 for r in report for k in ("sam3_inference", "erosion_diffusion", "deidentification"))
    failures = [json.loads(x) for f in (tmp_path / "out/failures.json").glob("*.json") for x in f.read_text().splitlines()]
    assert [(f["name"], f["stage"]) for f in failures] == [("broken.png", "sam3")] and "could not read" in failures[0]["error"]
    # The images themselves: masks, crops, and the redacted ones, in which no label is left.
    assert running.written == {"sam3/masks": 3, "postprocess/crops": 3, "deidentification/images": 3}
    for folder, name in (("sam3/masks", "a/x_patient_1_mask.png"), ("postprocess/crops", "z.png"), ("deidentification/images", "a-b/y_patient_2.png")):
        assert (tmp_path / "out" / folder / name).exists()
    drawn = {r.name: pixels.from_spark_image(r.height, r.width, r.channels, r.data) for r in images.read_images(spark, str(tmp_path / "out/deidentification/images")).collect()}
    crops = {r.name: pixels.from_spark_image(r.height, r.width, r.channels, r.data) for r in images.read_images(spark, str(tmp_path / "out/postprocess/crops")).collect()}
    white = lambda image: (image == 255).reshape(*image.shape[:2], -1).all(axis=2).any()
    assert set(drawn) == set(crops) and all(white(x) for x in crops.values()) and not any(white(x) for x in drawn.values())
    assert crops["z.png"][20, 30].tolist() == [90, 100, 110]
    said = [r.message for r in caplog.records]
    assert said[0] == "run started in mode full" and any("3 records written" in x for x in said) and "postprocess: 3 images done" in said
    told = events.image_events(out["sam3"], out["report"]).groupBy("event").count().collect()
    assert {r.event: r["count"] for r in told} == {"processing_image": 4, "image_completed": 3}
    again = stages.run(spark, config.parse_config(text + 'run_mode = "report"\n', tmp_path))
    assert again["report"].count() == 3


def test_what_cannot_be_read_stops_the_run(spark, tree, tmp_path):
    with pytest.raises(ValueError, match="broken.png"):
        stages.run(spark, config.parse_config(f'[pipeline]\ninput_path = "{tree}"\n{SETTINGS}', tmp_path))
    (tmp_path / "none").mkdir()
    (tmp_path / "none/notes.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        stages.run(spark, config.parse_config(f'[pipeline]\ninput_path = "none"\n{SETTINGS}', tmp_path))


def test_artifacts_can_be_left_out(spark, tree, tmp_path):
    running = stages.Run(spark, config.parse_config(f'[pipeline]\ninput_path = "{tree}"\nunreadable = "list"\nsave_artifacts = false\nrun_mode = "sam3"\n{SETTINGS}', tmp_path))
    assert set(running()) == {"sam3"} and running.written == {} and not (tmp_path / "out/sam3").exists()


def test_a_failing_reader_fails_no_other_image(spark, tree):
    class Picky(models.StubReader):
        def readtext(self, image, **options):
            if image.ndim == 2:
                raise ValueError("gray")
            return super().readtext(image)

    rows = models.read_each(images.read_images(spark, str(tree), invalid="drop"), Picky).collect()
    assert sorted((r.error, len(r.readings)) for r in rows if r.error) == [("ValueError: gray", 0)]
    assert [len(r.readings) for r in rows if not r.error] == [2, 2] and all(r.seconds > 0 for r in rows)


def test_fallback_prompt_and_isolated_failures(spark, tree):
    scans = images.read_images(spark, str(tree), invalid="drop")
    rows = stages.segment(scans, models.StubSegmenter, "nothing", "radiograph").collect()
    assert all(r.fallback and r.sam_boxes and r.error is None for r in rows)

    class Failing:
        def infer(self, image, prompt):
            raise RuntimeError("no model")

    failed = stages.postprocess(stages.segment(scans, Failing, "x"), 3, 1, 0.1)
    assert {r.error for r in failed.collect()} == {"ValueError: RuntimeError: no model"}


def test_model_replies(spark, tree):
    files = images.list_files(spark, str(tree)).select("name").withColumn("content", F.encode("name", "utf-8")).filter(F.col("name").endswith("png"))
    got = models.vlm_records(models.ask_vlm(files, models.StubVlm)).collect()
    assert all(len(r.boxes) == 1 and r.error is None for r in got)


@pytest.mark.parametrize("line", ['run_mode = "walk"', "kernel_size = 4", "kernel_size = true", 'max_area = "x"', "languages = []", "large_box_ratio = 0"])
def test_config_is_checked(tmp_path, line):
    base = '[pipeline]\ninput_path = "i"\noutput_dir = "o"\noutput_json = "j"\n'
    assert config.parse_config(base + "max_area = -1", tmp_path).max_area is None
    with pytest.raises(ValueError):
        config.parse_config(base + line, tmp_path)
    with pytest.raises(ValueError):
        config.parse_config("[other]", tmp_path)


def test_records_in_and_out(spark, tmp_path):
    path = tmp_path / "r.json"
    records.write_json_array(spark.range(2).select(F.concat(F.lit("n"), "id").alias("name"), F.lit(1.5).alias("deidentification_time"), F.array(F.array(F.lit(1), F.lit(2), F.lit(3), F.lit(4))).alias("boxes")), str(path))
    assert [r["name"] for r in json.loads(path.read_text())] == ["n0", "n1"]
    assert records.read_records(spark, str(path), schemas.DEIDENTIFICATION).count() == 2
    assert records.read_records(spark, str(tmp_path / "none.json"), schemas.DEIDENTIFICATION, required=False).count() == 0
    with pytest.raises(FileNotFoundError):
        records.read_records(spark, str(tmp_path / "none.json"), schemas.DEIDENTIFICATION)
    (tmp_path / "gt.json").write_text('{"i": {"shapes": [{"label": "t", "points": [[5, 6], [1, 2]]}, {"label": "u", "points": [[1, 1]]}]}, "j": {}}')
    assert [(r.img, tuple(r.r)) for r in records.read_ground_truth(spark, str(tmp_path / "gt.json")).collect()] == [("i", (1, 2, 5, 6))]
    (tmp_path / "old.json").write_text('{"d/i.png": [{"bbox": [[0, 0], [4, 0], [4, 2], [0, 2]], "text": "t", "confidence": 0.4}, {"bbox": [[0, 0], [1, 1]], "confidence": 0.9}]}')
    assert records.read_legacy_predictions(spark, str(tmp_path / "old.json"), 0.5).count() == 1
    assert records.read_legacy_predictions(spark, str(tmp_path / "old.json"), accept_bbox=False).count() == 0
    (tmp_path / "log.csv").write_text("timestamp_utc,relpath,status\n2024-01-01T00:00:00,a,ok\nbroken\n")
    assert [r.relpath for r in records.read_decisions(spark, str(tmp_path / "log.csv")).collect()] == ["a"]
    assert records.read_decisions(spark, str(tmp_path / "no.csv")).count() == 0


@pytest.fixture(scope="module")
def labelled(tree, tmp_path_factory):
    """Labelled boxes of two scans, one of them with a box that no prediction covers."""
    path = tmp_path_factory.mktemp("gt") / "gt.json"
    shape = lambda *points: {"label": "t", "points": list(points), "shape_type": "rectangle"}
    path.write_text(json.dumps({"x_patient_1": {"shapes": [shape([8, 8], [20, 12])]}, "z": {"shapes": [shape([60, 46], [80, 52]), shape([30, 30], [35, 35])]}}))
    return str(path)


def test_accuracy_of_files(spark, tree, labelled, tmp_path):
    pred = tmp_path / "pred.json"
    pred.write_text(json.dumps([{"name": "a/x_patient_1.png", "boxes": [[8, 8, 12, 4]]}, {"name": "z.png", "boxes": [[60, 46, 20, 6], [1, 1, 2, 2]]}, {"name": "q.png", "boxes": []}]))
    out = runners.accuracy_run(spark, labelled, str(pred), 0.0, image_root=str(tree), overlay_root=str(tmp_path / "drawn"))
    total = out["summary"].first()
    assert (total.n_gt, total.n_pred, total.n_full, total.n_uncovered, total.n_outside) == (3, 3, 2, 1, 1)
    assert [(r.img, r.n_not_full) for r in out["not_full"].collect()] == [("z", 1)]
    assert out["overlays"] == {"saved": 2, "missing": 0, "failed": 0}
    assert (tmp_path / "drawn/a/x_patient_1_overlay.png").exists()
    old = tmp_path / "old.json"
    old.write_text(json.dumps({"d/z.png": [{"bbox": [[60, 46], [80, 46], [80, 52], [60, 52]], "text": "t", "confidence": 0.4}]}))
    assert runners.accuracy_run(spark, labelled, str(old))["summary"].first().n_full == 1
    assert runners.accuracy_run(spark, labelled, str(old), min_confidence=0.5)["summary"].first().n_pred == 0


def test_language_models_are_asked_once(spark, tree, labelled, tmp_path):
    class Counting(models.StubVlm):
        def ask(self, image_url):
            with open(tmp_path / "asked", "a") as f:
                f.write("x")
            return super().ask(image_url)

    for reuse, asked in ((True, 2), (True, 2), (False, 4)):
        table = runners.vlm_run(spark, {"a/one": Counting}, str(tree), labelled, str(tmp_path / "vlm"), reuse=reuse)
        assert (tmp_path / "asked").stat().st_size == asked
        row = table.first()
        assert (row.model, row.n_gt, row.n_pred) == ("a/one", 3, 2)
    records_ = json.loads((tmp_path / "vlm/a_one.json").read_text())
    assert all(r["error"] == "" and len(r["boxes"]) == len(r["texts"]) == 1 and r["vlm_time"] >= 0 for r in records_)
    assert json.loads((tmp_path / "vlm/summary.json").read_text())[0]["model"] == "a/one"


def test_detached_postprocessing(spark, tree, tmp_path):
    root = tmp_path / "masks"
    for folder in ("d", "masks/e", "imgs/e"):
        (root / folder).mkdir(parents=True)
    scan = (tree / "z.png").read_bytes()
    mask = np.zeros((60, 90), np.uint8)
    mask[5:55, 5:85] = 255
    (root / "d/one.png").write_bytes(scan)
    (root / "d/one_mask.png").write_bytes(pixels.encode_png(mask))
    (root / "imgs/e/two.png").write_bytes(scan)
    (root / "masks/e/two_mask.png").write_bytes(pixels.encode_png(np.zeros((60, 90), np.uint8)))
    (root / "masks/e/two_labels.json").write_text(json.dumps({"boxes": [[20.0, 30.0, 10.0, 10.0]], "scores": [0.5]}))
    assert runners.postprocess_detached(spark, str(root), str(tmp_path / "out"), 3, 1) == 0
    done = {r["mask_relpath"]: r for r in json.loads((tmp_path / "out/postprocess/records.json").read_text())}
    assert done["d/one_mask.png"]["cut_size"] == [80, 50] and done["d/one_mask.png"]["source_image_relpath"] == "d/one.png"
    assert done["masks/e/two_mask.png"]["bounding_boxes"] == [[10, 10, 10, 20]] and done["masks/e/two_mask.png"]["source_image_relpath"] == "imgs/e/two.png"
    assert (tmp_path / "out/postprocess/crops/d/one.png").exists()
    (root / "d/lone_mask.png").write_bytes(pixels.encode_png(mask))
    assert runners.postprocess_detached(spark, str(root), str(tmp_path / "out"), 3, 1) == 1
    failed = [json.loads(x) for f in (tmp_path / "out/postprocess/failures.json").glob("*.json") for x in f.read_text().splitlines()]
    assert [(f["mask"], f["error"]) for f in failed] == [("d/lone_mask.png", "ValueError: no image belongs to this mask")]


def test_experiments(spark):
    r = "struct(CAST(x AS DOUBLE) AS x1, CAST(y AS DOUBLE) AS y1, CAST(x + 30 AS DOUBLE) AS x2, CAST(y + 10 AS DOUBLE) AS y2) AS r"
    dets = spark.sql(f"SELECT img, ix, {r}, 1000L AS w, 600L AS h, 't' AS text, 0.9D AS conf FROM VALUES ('a', 0, 10, 10), ('a', 1, 48, 10), ('a', 2, 540, 320), ('b', 0, 900, 20) AS v(img, ix, x, y)")
    gt = spark.sql(f"SELECT img, CAST(ix AS BIGINT) AS ix, {r} FROM VALUES ('a', 0, 10, 10), ('c', 0, 5, 5) AS v(img, ix, x, y)")
    out = runners.run_tasks(["all"], {"ablation": (dets, gt), "sensitivity": (dets, gt), "paddle": (spark.createDataFrame([("a.png", '[[[[[10,10],[40,10],[40,20],[10,20]],["t",0.9]]]]')], "name string, reply string"), gt)})
    assert set(out) == {"ablation", "sensitivity", "paddle"}
    ablated = {r.value: (r.n_pred, r.n_full, r.central_fp) for r in out["ablation"].collect()}
    assert ablated == {"on": (2, 1, 0), "off": (3, 1, 1)}
    swept = {(r.param, r.value): r.n_pred for r in out["sensitivity"].collect()}
    assert swept[("merge_distance", "5.0")] == 3 and swept[("merge_distance", "10.0")] == 2 and len(swept) == 9
    assert out["paddle"].first().n_full == 1
    lines = runners.latex_rows(out["ablation"].orderBy("value"), "value", "coverage").collect()
    assert lines[0].line == "off & 0{,}500 \\\\"
    with pytest.raises(ValueError):
        runners.run_tasks(["walk"], {})


def test_reports_of_a_run(spark):
    report = spark.sql("SELECT name, named_struct('times', named_struct('sam3_inference', s, 'erosion_diffusion', 1D, 'deidentification', 2D), 'rotation_angle', a) AS metrics FROM VALUES ('p/x', 1D, -1.5D), ('p/y', 3D, 0.2D), ('z', 5D, 1.9D) AS v(name, s, a)")
    assert {r.modality: (r.n, r.sam3, r.total) for r in runners.stage_times(report).collect()} == {"p": (2, 2.0, 5.0), "": (1, 5.0, 8.0)}
    assert {r.bin: r.n for r in runners.distribution(report).collect()} == {0: 1, 1: 2}


def test_another_make_of_reader():
    line = ([[1, 2], [5, 2], [5, 4], [1, 4]], ("hi", 0.5))

    class Old:
        def ocr(self, image, cls):
            return [[line, None, ([["a", 1]], ("x", 1))]]

    class New:
        def ocr(self, image):
            return [line, line]

    assert models.PaddleReader(Old).readtext(None) == [([(1, 2), (5, 2), (5, 4), (1, 4)], "hi", 0.5)]
    assert len(models.PaddleReader(New).readtext(None)) == 2
    assert models.PaddleReader(lambda: type("None_", (), {"ocr": lambda self, image, cls: None})()).readtext(None) == []


def test_files_by_name_and_time_of_writing(spark):
    listing = spark.createDataFrame([("a/x.png",), ("b/x.png",), ("y.png",)], "name string")
    assert {r.file: r.name for r in images.by_file_name(listing).collect()} == {"x.png": "b/x.png", "y.png": "y.png"}
    assert __import__("datetime").datetime.fromisoformat(spark.range(1).select(paths.utc_now()).first()[0]).utcoffset().total_seconds() == 0


def test_stream_lists_each_file_once(spark, tree, tmp_path):
    for _ in range(2):
        ingest.list_once(spark, str(tree), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
