"""The predicates that reports use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equals(rows: DataFrame, **values: object) -> DataFrame:
    """Rows where every named column has the given value."""
    for column, value in values.items():
        rows = rows.filter(F.col(column) == F.lit(value))
    return rows


def in_months(rows: DataFrame, *months: int, column: str = "month") -> DataFrame:
    """Rows of the given months; prunes directories when staged by month."""
    return rows.filter(F.col(column).isin(*months))


def between_exclusive(rows: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return rows.filter((F.col(column) > low) & (F.col(column) < high))


def exceeds(rows: DataFrame, column: str, threshold: float) -> DataFrame:
    return rows.filter(F.col(column) > threshold)
