"""Daily means of one month and the days that stand out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators import Mean, exceeds, in_months
from tripmart.plans.mart import Mart

JANUARY = 1


def daily_mean(dated: DataFrame, column: str, name: str, month: int = JANUARY) -> DataFrame:
    """Mean of a column per day of one month, for any table with a ``date``."""
    day = F.dayofmonth("date").alias("day")
    chosen = in_months(dated.withColumn("month", F.month("date")), month)
    return chosen.groupBy(day).agg(F.avg(column).alias(name)).orderBy("day")


def january_daily_wait(mart: Mart) -> DataFrame:
    def daily() -> DataFrame:
        return mart.report(
            {"day": F.dayofmonth("date")},
            ["date"],
            Mean("average_waiting_time", "request_to_pickup"),
            trips=in_months(mart.trips, JANUARY),
        )

    shared = mart.family("by day of January", daily)
    return (daily() if shared is None else shared).orderBy("day")


def wait_anomalies(mart: Mart, threshold: float = 300) -> DataFrame:
    return exceeds(january_daily_wait(mart), "average_waiting_time", threshold)
