"""Averages by time of day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import rank_order
from tripmart.operators import Mean, Metric
from tripmart.plans.mart import Mart

PAY = Mean("average_drive_total_pay", "driver_total_pay")
LENGTH = Mean("average_trip_length", "trip_length")


def _averages(mart: Mart, *metrics: Metric) -> DataFrame:
    def grouped(*some: Metric) -> DataFrame:
        return mart.report({"time_of_day": "time_of_day"}, ["time_of_day"], *some)

    shared = mart.family("by time of day", lambda: grouped(PAY, LENGTH))
    if shared is not None:
        return shared.select("time_of_day", *(m.name for m in metrics))
    return grouped(*metrics)


def avg_pay_by_time_of_day(mart: Mart) -> DataFrame:
    return _averages(mart, PAY).orderBy(*rank_order(PAY.name, "time_of_day"))


def avg_length_by_time_of_day(mart: Mart) -> DataFrame:
    return _averages(mart, LENGTH).orderBy(*rank_order(LENGTH.name, "time_of_day"))


def earning_per_mile(mart: Mart) -> DataFrame:
    """Ratio of the two averages, both taken in one pass.

    Stands for a join of the averages on the time of day, which drops a null key.
    """
    both = _averages(mart, PAY, LENGTH).filter(F.col("time_of_day").isNotNull())
    ratio = F.try_divide(F.col(PAY.name), F.col(LENGTH.name))
    return both.select("time_of_day", ratio.alias("average_earning_per_mile"))
