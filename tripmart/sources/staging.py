"""Typed trips as parquet, so that text is parsed and facts are joined only once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stage_trips(trips: DataFrame, path: str) -> None:
    """Write trips with a ``month`` column, one directory per month, or per year and month.

    The rebalance hint lets adaptive execution split a month that holds most of
    the rows and merge the small ones, which bounds both file size and the
    number of files.
    """
    levels = [c for c in ("year", "month") if c in trips.columns]
    trips.hint("rebalance", *levels).write.mode("overwrite").partitionBy(*levels).parquet(path)


def read_staged_trips(spark: SparkSession, path: str) -> DataFrame:
    """Staged trips; a filter on ``month`` prunes directories."""
    return spark.read.parquet(path)
