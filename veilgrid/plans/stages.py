"""The stage pipeline: segment, post-process, redact, report. Each stage is a DataFrame keyed by image name.

Model calls are costly and may not repeat exactly, so a stage is written before the next one reads it. Pixels travel only
inside the stage that needs them; the report joins records alone. What fails is listed with its stage and error, and an image
that cannot be read stops the run unless the configuration says otherwise: no image is left out in silence.
"""

from __future__ import annotations

import functools
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import models, pixels
from ..operators.detections import Params, redaction_boxes
from ..operators.records import last_of
from ..sources.config import PipelineConfig
from ..sources.images import list_files, read_images, require_some, scan_names, split_readable
from ..sources.records import write_images, write_json_array
from .events import EventLog

_MASKED = "name string, height int, width int, channels int, data binary, mask binary, sam_boxes array<array<int>>, seconds double, fallback boolean, error string"
_CROPPED = "name string, original_size array<int>, bounding_boxes array<array<int>>, triggered boolean, rotation_angle double, height int, width int, channels int, data binary, seconds double, error string"


def segment(images: DataFrame, factory: Callable, prompt: str, fallback: str | None = None) -> DataFrame:
    """Masks and boxes; where the prompt finds no box, the fallback prompt is tried, and its time counts too."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = models.built(factory)
        for f in frames:
            rows = []
            for r in f.itertuples():
                begun, again, mask, boxes, error = time.perf_counter(), False, None, [], None
                try:
                    image = pixels.from_spark_image(r.height, r.width, r.channels, r.data)
                    masks, found = model.infer(image, prompt)
                    if not found and fallback:
                        again = True
                        masks, found = model.infer(image, fallback)
                    stack = pixels.to_mask_stack(masks, (r.width, r.height)) if len(masks) else masks
                    boxes = [_clamped(b, r.width, r.height) for b in found] or [pixels.box_of(p) for m in stack if len(p := pixels.np.argwhere(m > 0))]
                    boxes = sorted((b for b in boxes if b), key=lambda b: -b[2] * b[3])
                    mask = pixels.combine(stack, boxes, image.shape[:2]).tobytes()
                except Exception as e:  # isolated: the row carries its error
                    error = f"{type(e).__name__}: {e}"
                rows.append((r.name, r.height, r.width, r.channels, r.data, mask, [list(b) for b in boxes], time.perf_counter() - begun, again, error))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _MASKED.split(", ")])

    return images.select("name", "height", "width", "channels", "data").mapInPandas(run, _MASKED)


def _clamped(b: tuple[float, float, float, float], width: int, height: int) -> tuple[int, int, int, int] | None:
    x1, x2 = (min(max(round(v), 0), width) for v in sorted((b[0], b[2])))
    y1, y2 = (min(max(round(v), 0), height) for v in sorted((b[1], b[3])))
    return (x1, y1, x2 - x1, y2 - y1) if x2 > x1 and y2 > y1 else None


def postprocess(segmented: DataFrame, kernel: int, iterations: int, ratio: float) -> DataFrame:
    """Straightened crops and the boxes of the cleaned mask; without any, the segmenter's boxes. The alarm looks at the
    boxes after this fallback against the uncropped image."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples():
                begun = time.perf_counter()
                try:
                    if r.error:
                        raise ValueError(r.error)
                    image = pixels.from_spark_image(r.height, r.width, r.channels, r.data)
                    mask = pixels.np.frombuffer(r.mask, pixels.np.uint8).reshape(image.shape[:2])
                    angle, best = 0.0, pixels.largest_fitting(mask)
                    if best is not None:
                        angle = pixels.rotation_to_zero(best)
                        image, mask = pixels.rotate(image, best[0], angle, smooth=True), pixels.rotate(mask, best[0], angle, smooth=False)
                    clean = pixels.open_mask(mask, kernel, iterations)
                    boxes = pixels.extract_boxes(clean) or [tuple(b) for b in r.sam_boxes]
                    large = sum(b[2] * b[3] >= ratio * r.width * r.height for b in boxes)
                    cut = pixels.crop(image, mask)
                    channels = 1 if cut.ndim == 2 else cut.shape[2]
                    data = (cut if channels == 1 else cut[..., ::-1]).tobytes()
                    rows.append((r.name, [r.width, r.height], [list(b) for b in boxes], large > 1, angle, cut.shape[0], cut.shape[1], channels, data, time.perf_counter() - begun, None))
                except Exception as e:
                    rows.append((r.name, [r.width, r.height], [], False, 0.0, 0, 0, 0, None, time.perf_counter() - begun, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _CROPPED.split(", ")])

    return segmented.mapInPandas(run, _CROPPED)


def recognise(crops: DataFrame, factory: Callable, passes: int = 1) -> DataFrame:
    """name, seconds, error, readings: text recognition of the sound crops. Costly, so write it before it is read."""
    return models.read_each(crops.filter("error is null"), factory, passes)


def deidentify(crops: DataFrame, read: DataFrame, p: Params) -> DataFrame:
    """name, boxes, seconds: the decision about the readings of :func:`recognise`, in Catalyst and one Arrow pass."""
    sound = crops.filter("error is null").select("name", F.col("width").alias("w"), F.col("height").alias("h"))
    readings = read.select("name", F.inline("readings")).select("name", "ix", G.quad_to_rect(F.col("quad")).alias("r"), "text", F.col("prob").alias("conf"))
    boxes = redaction_boxes(readings.join(sound, "name"), p, "name").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("pos", F.array("x", "y", "bw", "bh").alias("b")))).alias("all"))
    done = read.filter("error is null").select("name", "seconds")
    return done.join(boxes, "name", "left").select("name", F.coalesce(F.transform("all", lambda s: s["b"]), F.array().cast("array<array<int>>")).alias("boxes"), "seconds")


def redacted_images(crops: DataFrame, boxes: DataFrame, fill: bool = True) -> DataFrame:
    """name, height, width, channels, data (RGB or gray) with the boxes drawn. An outline leaves text readable; filling does not."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            drawn = [pixels.draw_boxes(pixels.from_spark_image(r.height, r.width, r.channels, r.data), [tuple(b) for b in r.boxes], fill=fill) for r in f.itertuples()]
            yield f[["name", "height", "width", "channels"]].assign(data=[d.tobytes() for d in drawn])

    joined = crops.filter("error is null").select("name", "height", "width", "channels", "data").join(boxes, "name")
    return joined.mapInPandas(run, "name string, height int, width int, channels int, data binary")


def build_report(segmented: DataFrame, crops: DataFrame, deid: DataFrame, empty_boxes: bool = False) -> DataFrame:
    """The final record of each post-processed image, with the time of each stage. Of several records of one name the last
    written counts. ``empty_boxes`` leaves the redaction boxes out, as an older report did."""
    s = last_of(segmented.select("name", F.monotonically_increasing_id().alias("pos"), F.col("seconds").alias("sam_seconds")), "name", "pos")
    d = last_of(deid.select("name", F.monotonically_increasing_id().alias("pos"), "boxes", F.col("seconds").alias("deid_seconds")), "name", "pos")
    zero = F.lit(0.0)
    times = F.struct(F.coalesce("sam_seconds", zero).alias("sam3_inference"), F.coalesce("seconds", zero).alias("erosion_diffusion"), F.coalesce("deid_seconds", zero).alias("deidentification"))
    motivation = F.when(F.col("triggered"), "several large boxes").otherwise("")
    joined = crops.filter("error is null").drop("data").join(s, "name", "left").join(d, "name", "left")
    return joined.select(
        "name", F.struct("triggered", motivation.alias("motivation")).alias("alarm"), "bounding_boxes",
        (F.array().cast("array<array<int>>") if empty_boxes else F.coalesce("boxes", F.array().cast("array<array<int>>"))).alias("deidentification_boxes"),
        F.struct(times.alias("times"), "original_size", F.array("width", "height").alias("cut_size"), "rotation_angle").alias("metrics"),
    )


def mask_images(segmented: DataFrame) -> DataFrame:
    """The masks as gray images named after their scans."""
    name = F.concat(F.regexp_replace("name", r"(?<=[^/])\.[^./]+$", ""), F.lit("_mask.png"))
    return segmented.filter("error is null").select(name.alias("name"), "height", "width", F.lit(1).alias("channels"), F.col("mask").alias("data"))


#: The stages in order; a mode runs one of them over what an earlier run wrote, or all of them.
ORDER = ("sam3", "postprocess", "deidentification", "report")


class Run:
    """One run over the images below ``input_path``, up to the configured mode."""

    def __init__(self, spark: SparkSession, config: PipelineConfig, segmenter: Callable = models.StubSegmenter, reader: Callable = models.StubReader, events: EventLog | None = None) -> None:
        self.spark, self.config, self.segmenter, self.reader = spark, config, segmenter, reader
        self.events = events or EventLog()
        self.tables: dict[str, DataFrame] = {}
        #: How many files of each kind were written.
        self.written: dict[str, int] = {}

    def _table(self, name: str, stage: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of a stage: written now if the mode asks for the stage, else as an earlier run left it."""
        path = str(self.config.output_dir / f"{name}.parquet")
        if self.config.run_mode in ("full", stage):
            make().write.mode("overwrite").parquet(path)
        self.tables[name] = self.spark.read.parquet(path)
        return self.tables[name]

    def _artifacts(self, stage: str, folder: str, make: Callable[[], DataFrame], order: str = "rgb") -> None:
        if self.config.save_artifacts and self.config.run_mode in ("full", stage):
            self.written[folder] = write_images(make(), str(self.config.output_dir / folder), order)

    def _scans(self) -> tuple[DataFrame, DataFrame]:
        """Images that can be read, and those that cannot; an empty tree is an error, and so is an unreadable image unless the
        configuration wants them listed."""
        require_some(scan_names(list_files(self.spark, str(self.config.input_path))))
        sound, failed = split_readable(read_images(self.spark, str(self.config.input_path)))
        if self.config.unreadable == "fail" and (first := [r.error for r in failed.orderBy("name").limit(5).collect()]):
            raise ValueError("; ".join(first))
        return sound, failed

    def _segment(self) -> DataFrame:
        sound, failed = self._scans()
        done = segment(sound, self.segmenter, self.config.prompt, self.config.fallback_prompt)
        unread = failed.select("name", *(F.lit(None).cast(f.dataType).alias(f.name) for f in done.schema.fields[1:-1]), "error").withColumn("fallback", F.lit(False))
        return done.unionByName(unread)

    def __call__(self) -> dict[str, DataFrame]:
        c, last = self.config, 3 if self.config.run_mode == "full" else ORDER.index(self.config.run_mode)
        self.events("pipeline_started", mode=c.run_mode)
        segmented = self._table("sam3", "sam3", self._segment)
        self._artifacts("sam3", "sam3/masks", lambda: mask_images(segmented))
        failures = [segmented.select("name", F.lit("sam3").alias("stage"), "error")]
        if last >= 1:
            crops = self._table("postprocess", "postprocess", lambda: postprocess(segmented.filter("error is null"), c.kernel_size, c.iterations, c.large_box_ratio))
            self._artifacts("postprocess", "postprocess/crops", lambda: crops.filter("error is null"), "bgr")
            failures.append(crops.select("name", F.lit("postprocess").alias("stage"), "error"))
        if last >= 2:
            p = Params(c.merge_distance, c.max_area, c.axis_x, c.axis_y, c.proximity, c.padding)
            read = self._table("readings", "deidentification", lambda: recognise(crops, self.reader))
            deid = self._table("deidentification", "deidentification", lambda: deidentify(crops, read, p))
            self._artifacts("deidentification", "deidentification/images", lambda: redacted_images(crops, deid))
            failures.append(read.select("name", F.lit("deidentification").alias("stage"), "error"))
        failed = functools.reduce(DataFrame.unionAll, failures).filter("error is not null")
        failed.write.mode("overwrite").json(str(c.output_dir / "failures.json"))
        if last >= 3:
            final = self._table("report", "report", lambda: build_report(segmented, crops, deid))
            self.events("report_written", records=write_json_array(final, str(c.output_json), "name"), path=c.output_json)
        for stage in ORDER[: last + 1]:
            if c.run_mode in ("full", stage):
                self.events("stage_completed", stage=stage, count=self.tables[stage].count())
        return self.tables


def run(spark: SparkSession, config: PipelineConfig, segmenter: Callable = models.StubSegmenter, reader: Callable = models.StubReader, events: EventLog | None = None) -> dict[str, DataFrame]:
    """Runs the stages up to the configured mode over the images below ``input_path``; returns the written stage tables."""
    return Run(spark, config, segmenter, reader, events)()
