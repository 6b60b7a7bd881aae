"""Runs over files: accuracy, language models, post-processing on its own, experiments, overlays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import paths as P
from ..operators import evaluate, models
from ..operators.detections import sweep
from ..operators.records import first_existing
from ..sources import images, records, schemas
from . import stages

PREDICTION = f"name string, boxes {schemas.BOXES}, deidentification_boxes {schemas.BOXES}"


def read_predictions(spark: SparkSession, path: str, min_confidence: float = 0.0) -> DataFrame:
    """img, ix, r from a list of records, or from the older object keyed by file name."""
    if spark.read.text(path).filter("trim(value) <> ''").first().value.lstrip().startswith("{"):
        return records.read_legacy_predictions(spark, path, min_confidence).select("img", "ix", "r")
    return prediction_rects(records.read_records(spark, path, PREDICTION))


def prediction_rects(rows: DataFrame) -> DataFrame:
    """img (stem), ix, r of records with boxes; boxes of records with one stem are all counted."""
    boxes = [F.col(c) for c in ("deidentification_boxes", "boxes") if c in rows.columns]
    each = rows.select(P.stem(F.col("name")).alias("img"), F.posexplode(F.coalesce(*boxes)).alias("ix", "b"))
    return each.filter(F.size("b") == 4).select("img", "ix", G.rect(*(F.col("b")[k] + (F.col("b")[k - 2] if k > 1 else 0) for k in range(4))).alias("r"))


def accuracy_run(spark: SparkSession, ground_truth: str, predictions: str, margin: float = 0.0, min_confidence: float = 0.0, image_root: str | None = None, overlay_root: str | None = None) -> dict[str, DataFrame | dict[str, int]]:
    """Tables per_image, summary and not_full (images with labelled boxes that are not fully covered), and, with an overlay
    folder, how many overlays were saved or found no image."""
    gt = records.read_ground_truth(spark, ground_truth)
    pred = read_predictions(spark, predictions, min_confidence)
    per_image = evaluate.per_image(gt, pred, margin, "img")
    not_full = per_image.filter("n_gt > n_full").select("img", (F.col("n_gt") - F.col("n_full")).alias("n_not_full"), "n_gt")
    out: dict = {"per_image": per_image, "summary": evaluate.summary(per_image), "not_full": not_full}
    if overlay_root is not None:
        out["overlays"] = render_overlays(spark, image_root, per_image.select("img"), gt, pred, overlay_root)
    return out


def render_overlays(spark: SparkSession, image_root: str, wanted: DataFrame, gt: DataFrame, pred: DataFrame, out_root: str, fill: bool = False) -> dict[str, int]:
    """Draws labelled and predicted boxes on the images of the wanted stems. Returns how many were saved, found no image, failed."""
    index = images.index_by_stem(images.list_files(spark, image_root), P.IMAGE_SUFFIXES)
    found = wanted.join(index.withColumnRenamed("stem", "img"), "img", "left")
    boxes = gt.select("img", "r").unionAll(pred.select("img", "r")).groupBy("img").agg(F.collect_list(F.array(*(G.half_even(F.col(f"r.{a}") - (F.col(f"r.{b}") if b else F.lit(0))) for a, b in (("x1", ""), ("y1", ""), ("x2", "x1"), ("y2", "y1"))))).alias("boxes"))
    pixels = images.read_images(spark, image_root).withColumn("error", F.when(F.col("height") < 0, "unreadable"))
    named = found.filter("name is not null").join(boxes, "img").select("name", "boxes")
    there = pixels.join(named.select("name"), "name", "left_semi")
    drawn = stages.redacted_images(there, named, fill).withColumn("name", F.concat(F.regexp_replace("name", r"(?<=[^/])\.[^./]+$", ""), F.lit("_overlay.png")))
    saved = records.write_images(drawn, out_root)
    return {"saved": saved, "missing": found.filter("name is null").count(), "failed": there.filter("height < 0").count()}


def vlm_run(spark: SparkSession, factories: dict[str, Callable], image_root: str, ground_truth: str, out_dir: str, margin: float = 0.0, reuse: bool = True, max_images: int = 0) -> DataFrame:
    """Asks each model about the images that have labels, unless its records are there and may be used again; writes the records
    of each model and one summary. model, and the columns of :func:`evaluate.summary`."""
    gt = records.read_ground_truth(spark, ground_truth)
    index = images.index_by_stem(images.list_files(spark, image_root), P.IMAGE_SUFFIXES).join(gt.select(F.col("img").alias("stem")).distinct(), "stem", "left_semi")
    if max_images > 0:
        index = images.in_path_order(index).limit(max_images)
    summaries = []
    for model, factory in factories.items():
        path = f"{out_dir}/{model.replace('/', '_')}.json"
        if not (reuse and records.exists(spark, path)):
            images.require_some(index)
            files = images.file_contents(spark, image_root).join(index.select("name"), "name", "left_semi")
            asked = models.vlm_records(models.ask_vlm(files, factory))
            wire = asked.select("name", F.transform("boxes", lambda b: F.array(b["x"], b["y"], b["w"], b["h"])).alias("boxes"), F.transform("boxes", lambda b: b["text"]).alias("texts"), F.col("seconds").alias("vlm_time"), F.coalesce("error", F.lit("")).alias("error"))
            records.write_json_array(wire, path)
        rows = records.read_records(spark, path, schemas.VLM)
        per_image = evaluate.per_image(gt, prediction_rects(rows), margin, "img")
        summaries.append(evaluate.summary(per_image.withColumn("model", F.lit(model)), "model"))
    out = summaries[0]
    for more in summaries[1:]:
        out = out.unionAll(more)
    records.write_json_array(out, f"{out_dir}/summary.json", "model")
    return out


def postprocess_detached(spark: SparkSession, root: str, artifacts: str, kernel: int = 9, iterations: int = 5, ratio: float = 0.1) -> int:
    """Post-processes the masks that lie below a folder, each with the image that belongs to it; writes records, failures and
    crops, and returns the exit code: 1 if any mask failed."""
    listing = images.list_files(spark, root)
    masks = images.require_some(listing.filter(F.col("name").endswith("_mask.png")), "masks").select(F.col("name").alias("mask"))
    labels = records.read_labels(spark, root)
    labels = labels.select(F.regexp_replace(images.relative(F.col("path"), root), r"_labels\.json$", "_mask.png").alias("mask"), F.col("image_file").alias("label_image"), F.col("boxes").alias("label_boxes"))
    known = masks.join(labels, "mask", "left")
    base, folder = F.regexp_replace("mask", r"_mask\.png$", ""), F.regexp_extract("mask", r"^(.*/)?[^/]*$", 1)
    tail = F.regexp_extract(base, r"^(?:.*?/)?masks/(.+)$", 1)
    beside = [F.concat(base, F.lit(f".{s}")) for s in P.IMAGE_SUFFIXES]
    labelled = F.when(F.trim("label_image") != "", F.trim("label_image"))
    elsewhere = [F.when(tail != "", F.concat(F.lit("imgs/"), tail, F.lit(f".{s}"))) for s in P.IMAGE_SUFFIXES]
    options = known.select("mask", F.array_compact(F.array(*beside, F.concat(folder, labelled), labelled, *elsewhere)).alias("candidates"))
    paired = known.select("mask", "label_boxes").join(first_existing(options, listing.select(F.col("name").alias("path")), "mask"), "mask", "left")
    pixels = images.read_images(spark, root)
    source = pixels.select(F.col("name").alias("path"), "height", "width", "channels", "data")
    mask = pixels.select(F.col("name").alias("mask"), *(F.col(c).alias(f"mask_{c}") for c in ("height", "width", "channels", "data")))
    both = paired.join(source, "path", "left").join(mask, "mask", "left")
    error = (
        F.when(F.col("path").isNull(), "no image belongs to this mask").when(F.coalesce("height", F.lit(-1)) < 0, "could not read image")
        .when(F.coalesce("mask_height", F.lit(-1)) < 0, "could not read mask").when((F.col("mask_height") != F.col("height")) | (F.col("mask_width") != F.col("width")), "mask and image differ in size")
    )
    clamped = F.filter(F.transform(F.coalesce("label_boxes", F.array().cast("array<array<double>>")), lambda v: F.when(F.size(v) == 4, G.xyxy_to_clamped_box(v[0], v[1], v[2], v[3], F.lit(2**30), F.lit(2**30)))), lambda b: b.isNotNull())
    boxes = F.transform(G.by_area(clamped), lambda b: F.array(b["x"], b["y"], b["w"], b["h"]))
    whole = [F.coalesce(c, F.lit(0)).alias(c) for c in ("height", "width", "channels")]  # a null would turn a batch's numbers into floats
    segmented = both.select(F.col("mask").alias("name"), *whole, "data", F.col("mask_data").alias("mask"), boxes.alias("sam_boxes"), error.alias("error"), "path")
    done = stages.postprocess(segmented, kernel, iterations, ratio)
    table = f"{artifacts}/postprocess/stage.parquet"
    done.join(paired.select(F.col("mask").alias("name"), F.col("path").alias("source")), "name").write.mode("overwrite").parquet(table)
    written = spark.read.parquet(table)
    sound = written.filter("error is null")
    name = P.mask_image_name(F.col("name"), F.concat(F.lit("."), P.suffix(F.col("source"))))
    motivation = F.when(F.col("triggered"), "several large boxes").otherwise("")
    wire = sound.select(
        name.alias("name"), "original_size", F.lit(0.0).alias("sam3_inference_time"), F.col("seconds").alias("erosion_diffusion_time"), F.struct("triggered", motivation.alias("motivation")).alias("alarm"), "bounding_boxes",
        F.array("width", "height").alias("cut_size"), "rotation_angle", P.png_path(name).alias("crop_relpath"), F.col("name").alias("mask_relpath"), F.col("source").alias("source_image_relpath"),
    )
    records.write_json_array(wire, f"{artifacts}/postprocess/records.json", "mask_relpath")
    records.write_images(sound.withColumn("name", name), f"{artifacts}/postprocess/crops", "bgr")
    return records.write_failures(written.select(F.col("name").alias("mask"), "error"), f"{artifacts}/postprocess/failures.json")


# --- experiments -----------------------------------------------------------------------------------------------------
#: The parameters that the experiments vary, around the shipped settings.
SWEEP = {"merge_distance": (5.0, 10.0, 20.0), "max_area": (60000.0, 120000.0, None), "padding": (0, 10, 20)}
ELLIPSE = {"on": (0.45, 0.35), "off": (0.001, 0.001)}
_SHIPPED = {"merge_distance": 10.0, "max_area": 120000.0, "padding": 10, "axis_x": 0.45, "axis_y": 0.35}
_GRID = "param string, value string, merge_distance double, max_area double, padding int, axis_x double, axis_y double"


def _scored(dets: DataFrame, gt: DataFrame, grid: list[dict], margin: float) -> DataFrame:
    """The summary of every row of a grid. dets: img, ix, r, w, h, text, conf; gt: img, ix, r."""
    table = dets.sparkSession.createDataFrame([tuple(g[c.split()[0]] for c in _GRID.split(", ")) for g in grid], _GRID)
    boxes = sweep(dets, table, "img").withColumn("ix", F.lit(0).cast("long"))
    labelled = gt.crossJoin(F.broadcast(table.select("param", "value")))  # a literal of a few rows
    keys = ("param", "value", "img")
    compared = evaluate.per_image(labelled, boxes, margin, *keys)
    central = evaluate.central(boxes).groupBy("param", "value").agg(F.count("*").alias("central_fp"))
    return evaluate.summary(compared, "param", "value").join(central, ["param", "value"], "left").fillna(0, ["central_fp"])


def ablation(dets: DataFrame, gt: DataFrame, margin: float = 5.0) -> DataFrame:
    """With the central ellipse and without."""
    return _scored(dets, gt, [{**_SHIPPED, "param": "ellipse", "value": k, "axis_x": x, "axis_y": y} for k, (x, y) in ELLIPSE.items()], margin)


def sensitivity(dets: DataFrame, gt: DataFrame, margin: float = 5.0) -> DataFrame:
    """One parameter at a time."""
    return _scored(dets, gt, [{**_SHIPPED, "param": k, "value": str(v), k: v} for k, values in SWEEP.items() for v in values], margin)


def stage_times(report: DataFrame) -> DataFrame:
    """modality (the first folder of a name), n, and the mean seconds of each stage and of all of them."""
    times = F.col("metrics.times")
    means = {n: F.avg(times[c]) for n, c in (("sam3", "sam3_inference"), ("post", "erosion_diffusion"), ("deid", "deidentification"))}
    modality = F.when(F.col("name").contains("/"), F.element_at(F.split("name", "/"), 1)).otherwise("").alias("modality")
    return report.groupBy(modality).agg(F.count("*").alias("n"), *(m.alias(n) for n, m in means.items()), sum(means.values()).alias("total"))


def distribution(report: DataFrame) -> DataFrame:
    """bin, n: rotation angles in steps of one degree."""
    return evaluate.degree_histogram(report.select(F.col("metrics.rotation_angle").alias("theta")), "theta")


def paddle(replies: DataFrame, gt: DataFrame, margin: float = 5.0) -> DataFrame:
    """The summary of another reader's replies. replies: name, reply (JSON)."""
    each = replies.select(P.stem(F.col("name")).alias("img"), F.posexplode(G.paddle_boxes(F.col("reply"))).alias("ix", "b"))
    return evaluate.summary(evaluate.per_image(gt, each.select("img", "ix", G.xywh_to_rect(F.col("b")).alias("r")), margin, "img"))


TASKS: dict[str, Callable[..., DataFrame]] = {"bench": stage_times, "ablation": ablation, "sensitivity": sensitivity, "paddle": paddle, "dist": distribution}


def run_tasks(names: list[str], inputs: dict[str, tuple]) -> dict[str, DataFrame]:
    """The results of the named tasks, or of all; a task whose inputs are missing is left out."""
    chosen = list(TASKS) if "all" in names else names
    if unknown := set(chosen) - set(TASKS):
        raise ValueError(f"no such task: {', '.join(sorted(unknown))}")
    return {n: TASKS[n](*inputs[n]) for n in chosen if n in inputs}


def latex_rows(table: DataFrame, label: str, *columns: str) -> DataFrame:
    """label, line: a table row of each record, numbers with a decimal comma."""
    cells = [P.latex_number(F.col(c)) for c in columns]
    return table.select(label, F.concat(F.concat_ws(" & ", F.col(label).cast("string"), *cells), F.lit(" \\\\")).alias("line"))
