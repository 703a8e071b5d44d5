from __future__ import annotations

from datetime import date

import pytest

from tests.conftest import plan, rows
from tripmart.operators import in_months
from tripmart.schemas import DAILY_WAIT_REPORT, MONTHLY_PROFIT_REPORT
from tripmart.sources import (
    read_report,
    read_staged_trips,
    run_path,
    stage_trips,
    write_report,
)


def test_round_trip_with_spaced_headings(spark, tmp_path):
    report = spark.createDataFrame(
        [("A", 1, -1.5), ("B", 2, 1e8)], "business string, month int, platform_profit double"
    )
    path = run_path(str(tmp_path), "run-1", "profit")
    write_report(report, path, single_file=True)
    files = [f for f in (tmp_path / "run-1" / "profit").iterdir() if f.suffix == ".csv"]
    assert len(files) == 1
    assert files[0].read_text().splitlines()[0] == "business,month,Platform Profit"
    assert rows(read_report(spark, path, MONTHLY_PROFIT_REPORT)) == rows(report)


def test_overwrite_keeps_order_and_replaces(spark, tmp_path):
    path = str(tmp_path / "days")
    days = spark.createDataFrame([(d, d * 1.5) for d in range(1, 32)], DAILY_WAIT_REPORT)
    write_report(days, path)
    write_report(days.repartition(4).orderBy("day"), path)
    back = [r.day for r in read_report(spark, path, DAILY_WAIT_REPORT).collect()]
    assert back == list(range(1, 32))


def test_run_id_must_be_safe_in_a_path():
    with pytest.raises(ValueError, match="run id"):
        run_path("out", "01-02-2023_10:11:12", "profit")


def test_staged_trips_prune_by_month(spark, tmp_path):
    trips = spark.createDataFrame(
        [("A", date(2023, m, 1), m) for m in (1, 1, 2, 5)], "business string, date date, month int"
    )
    stage_trips(trips, str(tmp_path / "staged"))
    staged = read_staged_trips(spark, str(tmp_path / "staged"))
    assert rows(staged.select("business", "date", "month")) == rows(trips)
    assert "PartitionFilters: [isnotnull(month" in plan(in_months(staged, 1))
    assert in_months(staged, 1).count() == 2
