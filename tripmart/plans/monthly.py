"""Per provider and month."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart.operators import Count, Metric, Total, equals
from tripmart.plans.mart import Mart

TRIPS = Count("trip_count")
PROFIT = Total("platform_profit", "rideshare_profit", digits=4)
EARNINGS = Total("driver_earnings", "driver_total_pay", digits=4)
KEYS = ("business", "month")


def monthly_report(
    mart: Mart, *metrics: Metric, keys: tuple[str, ...] | None = None
) -> DataFrame:
    """Metrics per key; a mart that carries the year has it as a further key."""
    if keys is None:
        keys = ("business", "year", "month") if "year" in mart.trips.columns else KEYS

    def grouped(*some: Metric) -> DataFrame:
        return mart.report({key: key for key in keys}, list(keys), *some)

    shared = mart.family(f"by {keys}", lambda: grouped(TRIPS, PROFIT, EARNINGS))
    if shared is not None and {*metrics} <= {TRIPS, PROFIT, EARNINGS}:
        return shared.select(*keys, *(m.name for m in metrics))
    return grouped(*metrics)


def monthly_trip_count(mart: Mart) -> DataFrame:
    return monthly_report(mart, TRIPS)


def monthly_platform_profit(mart: Mart) -> DataFrame:
    return monthly_report(mart, PROFIT)


def monthly_driver_earnings(mart: Mart) -> DataFrame:
    return monthly_report(mart, EARNINGS)


def monthly_all(mart: Mart) -> DataFrame:
    """The three measures in one pass."""
    return monthly_report(mart, TRIPS, PROFIT, EARNINGS)


def provider_series(report: DataFrame, business: str) -> DataFrame:
    """One provider's months in order; the filter reaches the scan below the report."""
    order = [c for c in ("year", "month") if c in report.columns]
    return equals(report, business=business).orderBy(*order)
