"""Stage tables in the folder that all executors share, and stable places of rows.

An operator that needs a result twice, or that must cut its lineage, writes it as Parquet below
``spark.checkpoint.dir`` and reads it back, so a lost executor costs a re-read and not a re-computation.
Where that setting is missing, a session on one machine gets a temporary folder of this process; on a cluster that is
an error, since executors would write to disks of their own.
"""

from __future__ import annotations

import atexit
import contextlib
import gc
import itertools
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SERIAL = itertools.count()
#: Paths of this process's stage tables that still stand, with their sessions.
_OPEN: dict[str, SparkSession] = {}
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)
_LOCAL: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the session; a process-local one only on a single machine whose session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master or ""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="veilgrid-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return f"file://{_LOCAL[0]}"


@contextlib.contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the stage tables that are made inside the block by this thread; a block around it has them too."""
    made: list[str] = []
    outer = _MADE.get()
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        if outer is not None:
            outer += made


def stage_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_root(spark)}/veilgrid/{next(_SERIAL):06d}-{name}-{uuid.uuid4().hex[:12]}"
    _OPEN[path] = spark
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once and returns a scan of what was written (same columns and types)."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stage_path = path  # for discard()
    return table


def delete(paths: list[str], keep: DataFrame | None = None) -> None:
    """Deletes these stage tables, but the one that ``keep`` scans. Call it once their readers have been materialised."""
    kept = getattr(keep, "_stage_path", None)
    for path in paths:
        if path != kept and (spark := _OPEN.pop(path, None)) is not None:
            with contextlib.suppress(Exception):  # the session may have ended; its folder then goes with it
                target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Deletes the stage tables that these scan, once nothing reads them any more."""
    delete([t._stage_path for t in tables])


def sweep(spark: SparkSession) -> None:
    """Lets shuffle files go whose results have been written: Spark deletes them when the driver's JVM finds them
    unreachable, which may take half an hour if it has memory to spare."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


atexit.register(lambda: delete(list(_OPEN)))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text becomes the empty text. Other columns, whatever their names, go."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def as_scan(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` itself if it is a plain scan of Parquet files, else a stage table with its rows."""
    plan = df._jdf.queryExecution().analyzed()
    if plan.nodeName() == "LogicalRelation" and {"file_path", "row_index"} <= set(_metadata_fields(df)):
        return df
    return stage_table(df, name)


def _metadata_fields(df: DataFrame) -> list[str]:
    try:
        return df.select(df.metadataColumn("_metadata").alias("m")).schema["m"].dataType.fieldNames()
    except Exception:  # a source without files
        return []


PLACE = ["file", "at"]


def place_of(scan: DataFrame) -> list:
    """Columns ``file`` and ``at`` of a scan (see :func:`as_scan`): the hash of a row's file and its number in it. They are
    the same in every scan, however the files are split among tasks, and no two rows share them."""
    stored = scan.metadataColumn("_metadata")
    return [F.xxhash64(stored["file_path"]).alias("file"), stored["row_index"].alias("at")]
