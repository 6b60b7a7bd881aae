"""Incremental forms: new scans as they arrive, and the decision log as an append-only stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import paths as P
from ..sources import schemas


def new_scans(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """path, length, modificationTime, content of image files that appear below a folder."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).load(root)
    return files.filter(P.is_image(F.col("path")))


def list_once(spark: SparkSession, root: str, out: str, checkpoint: str) -> StreamingQuery:
    """Appends the listing of files not seen before, then stops; the checkpoint remembers what was seen."""
    listing = new_scans(spark, root).select("path", "length", "modificationTime")
    return listing.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def decision_counts(spark: SparkSession, root: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Decisions per status and window of an appended log, with a watermark for late rows."""
    log = spark.readStream.schema(schemas.DECISIONS).option("header", True).csv(root)
    return log.withWatermark("timestamp_utc", late).groupBy(F.window("timestamp_utc", window), "status").agg(F.count("*").alias("n"))
