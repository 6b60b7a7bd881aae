"""Scans and sinks of records: JSON arrays, label files, decision logs, dead letters, image files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import paths as P
from ..operators import pixels
from . import schemas


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_records(spark: SparkSession, path: str, schema: str, required: bool = True) -> DataFrame:
    """A JSON array (or lines) of records. A missing optional file is an empty table; malformed input fails."""
    if not exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=True)


def write_json_array(df: DataFrame, path: str, order_by: str | None = None) -> int:
    """One JSON array in one file, a record a line, and how many there are. The records pass through the driver a partition at a time;
    ``df.write.json`` writes the same lines from the executors."""
    spark = df.sparkSession
    rows = (df.orderBy(order_by) if order_by else df).select(F.to_json(F.struct(*df.columns)).alias("line"))
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    count, held = 0, ["["]
    try:
        for row in rows.toLocalIterator():
            held.append(("," if count else "") + "\n" + row.line)
            count += 1
            if len(held) >= 1000:
                stream.write(bytearray("".join(held).encode()))
                held = []
        stream.write(bytearray("".join([*held, "\n]\n"]).encode()))
    finally:
        stream.close()
    return count


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """img, ix, label, r of one JSON object keyed by image; shapes with fewer than two points are skipped, keys are kept whole."""
    text = spark.read.text(path, wholetext=True)
    images = text.select(F.explode(F.from_json("value", schemas.GROUND_TRUTH)).alias("img", "entry"))
    shapes = images.select("img", F.posexplode("entry.shapes").alias("ix", "shape")).filter(F.size("shape.points") >= 2)
    return shapes.select("img", "ix", "shape.label", G.quad_to_rect(F.col("shape.points")).alias("r"))


def read_legacy_predictions(spark: SparkSession, path: str, min_confidence: float = 0.0, accept_bbox: bool = True) -> DataFrame:
    """img (stem), ix, text, confidence, r of a JSON object keyed by file name. Without ``accept_bbox`` only the key ``boxes`` counts."""
    text = spark.read.text(path, wholetext=True)
    items = text.select(F.explode(F.from_json("value", schemas.LEGACY)).alias("name", "items")).select("name", F.posexplode("items").alias("ix", "item"))
    quad = F.coalesce("item.boxes", "item.bbox") if accept_bbox else F.col("item.boxes")
    kept = items.filter(F.coalesce("item.confidence", F.lit(0.0)) >= min_confidence).withColumn("quad", quad).filter(F.size("quad") >= 2)
    return kept.select(P.stem(F.col("name")).alias("img"), "ix", "item.text", F.coalesce("item.confidence", F.lit(0.0)).alias("confidence"), G.quad_to_rect(F.col("quad")).alias("r"))


def read_labels(spark: SparkSession, root: str) -> DataFrame:
    """path, boxes (xyxy), scores, prompt, image_file of all label files below a folder."""
    files = spark.read.schema(schemas.LABELS).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*_labels.json").json(root)
    return files.select(F.col("_metadata.file_path").alias("path"), "*")


def require_lists(labels: DataFrame) -> DataFrame:
    return labels.filter(F.assert_true(F.col("boxes").isNotNull() & F.col("scores").isNotNull(), "boxes and scores must be lists").isNull())


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """timestamp_utc, relpath, status; malformed lines are dropped, a missing log is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.DECISIONS)
    return spark.read.schema(schemas.DECISIONS).option("mode", "DROPMALFORMED").csv(path, header=True)


def append_decisions(decisions: DataFrame, path: str) -> None:
    decisions.select("timestamp_utc", "relpath", "status").write.mode("append").option("header", True).csv(path)


def write_failures(results: DataFrame, path: str) -> int:
    """Writes mask and error of the failed rows; the exit code is 1 if there are any."""
    failed = results.filter(F.col("error").isNotNull()).select("mask", "error")
    failed.write.mode("overwrite").json(path)
    return int(not failed.isEmpty())


def png_column(images: DataFrame, order: str = "rgb") -> DataFrame:
    """name, content: PNG files of name, height, width, channels, data (gray, or three channels in this order)."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            shape = lambda r: (r.height, r.width) if r.channels == 1 else (r.height, r.width, r.channels)
            decoded = [pixels.from_spark_image(r.height, r.width, r.channels, r.data) if order == "bgr" else np.frombuffer(r.data, np.uint8).reshape(shape(r)) for r in f.itertuples()]
            yield pd.DataFrame({"name": f["name"], "content": [pixels.encode_png(x) for x in decoded]})

    return images.select("name", "height", "width", "channels", "data").mapInPandas(encode, "name string, content binary")


def write_images(images: DataFrame, root: str, order: str = "rgb") -> int:
    """Writes one PNG below ``root`` for each row, from the executors, and returns how many, in one pass. ``root`` is a folder
    that all executors share: a mounted path or an address that Arrow's file systems know. A file appears whole or not at all,
    so a task may run again."""

    def save(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = pa_fs.FileSystem.from_uri(root)
        for f in frames:
            for name, content in zip(f["name"], f["content"], strict=True):
                target = f"{base}/{name}"
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                part = f"{target}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(part) as out:
                    out.write(content)
                store.move(part, target)
            yield pd.DataFrame({"n": [len(f)]})

    files = png_column(images, order).withColumn("name", P.png_path(F.col("name")))
    return files.mapInPandas(save, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
