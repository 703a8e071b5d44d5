"""Top rows, per group and overall."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions import rank_order


def top_n_per_group(
    rows: DataFrame, group: list[str], measure: str, ties: list[str], n: int
) -> DataFrame:
    """The n rows of each group with the largest measure.

    The rank filter becomes a window group limit: every task keeps n rows per
    group before the shuffle, so no group arrives whole at one task.
    """
    ranked = Window.partitionBy(*group).orderBy(*rank_order(measure, *ties))
    return (
        rows.withColumn("row_num", F.row_number().over(ranked))
        .filter(F.col("row_num") <= n)
        .drop("row_num")
    )


def top_k(rows: DataFrame, measure: str, ties: list[str], k: int) -> DataFrame:
    """The k rows with the largest measure, in that order."""
    return rows.orderBy(*rank_order(measure, *ties)).limit(k)
