from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tripmart-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed: dict[str, str | None] = {}

    def put(key: str, value: object) -> None:
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, str(value))

    yield put
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows(frame) -> list[tuple]:
    """Rows as sorted tuples, nulls included."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def final_plan(frame) -> str:
    """The plan as adaptive execution left it after a run."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()
