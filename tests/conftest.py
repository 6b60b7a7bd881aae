from __future__ import annotations

import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = DATA / "sf0.001"
    if not path.exists():
        pytest.skip("no test tables here")
    return str(path)


@pytest.fixture(scope="session")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).iterdir()):
        name = path.name.removesuffix(".parquet")
        files = f"{path}/*.parquet" if path.is_dir() else str(path)
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return connection


def rows_of(frame):
    """Rows of a pandas frame as comparable tuples, columns by name, in any order."""

    def plain(v):
        if pd.api.types.is_scalar(v) and pd.isna(v):
            return "none"
        if hasattr(v, "item"):
            v = v.item()
        return round(v, 9) if isinstance(v, float) else v if isinstance(v, (bool, int, str)) else str(v)

    ordered = frame[sorted(frame.columns)]
    return sorted((tuple(map(plain, r)) for r in ordered.itertuples(index=False)), key=str)
