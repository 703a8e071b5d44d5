from __future__ import annotations

import pytest

import run_reports
from tests.test_lines import TRIP_HEADER
from tripmart.plans import Mart, monthly
from tripmart.schemas import (
    DAILY_WAIT_REPORT,
    MONTHLY_COUNT_REPORT,
    MONTHLY_EARNINGS_REPORT,
    ZONE_SCHEMA,
)
from tripmart.sources import read_report

ZONES = [
    "LocationID,Borough,Zone,service_zone",
    '1,"North","Alpha","Boro"',
    '2,"North","Beta","Boro"',
    '3,"South","Gamma","Yellow"',
]

JAN_1, JAN_2, FEB_1 = 1672531200, 1672617600, 1675209600


def trip(business, start, end, wait, when, seconds, pay):
    return f"{business},{start},{end},2.0,{wait},600,5,605,{when},{seconds},20,{pay},1.5,90,9"


TRIPS = [
    TRIP_HEADER,
    trip("P", 1, 2, 100, "morning", JAN_1, 10),
    trip("P", 1, 3, 500, "evening", JAN_1, 20),
    trip("Q", 1, 3, 900, "evening", JAN_2, 30),
    trip("Q", 2, 2, 100, "morning", FEB_1, 40),
    trip("Q", 2, 77, 100, "morning", FEB_1, 40),  # unknown zone
    "P,1,2,broken",
]


def arguments(tmp_path, *more):
    (tmp_path / "trips.csv").write_text("\n".join(TRIPS) + "\n")
    (tmp_path / "zones.csv").write_text("\n".join(ZONES) + "\n")
    return run_reports.options(
        [
            *("--trips", str(tmp_path / "trips.csv"), "--zones", str(tmp_path / "zones.csv")),
            *("--out", str(tmp_path / "out"), "--run-id", "r1", "--providers", "P", "Q"),
            *("--time-of-day", "evening", "--origin", "North", "--destination", "South"),
            *more,
        ]
    )


def test_all_reports_from_text_files(spark, tmp_path):
    paths = run_reports.run(spark, arguments(tmp_path, "--stage", str(tmp_path / "stage")))
    assert len(paths) == 26
    by_name = {p.rsplit("/", 1)[1]: p for p in paths}

    def saved(name, schema):
        return sorted(tuple(r) for r in read_report(spark, by_name[name], schema).collect())

    assert saved("monthly_trip_count", MONTHLY_COUNT_REPORT) == [
        ("P", 1, 2),
        ("Q", 1, 1),
        ("Q", 2, 1),
    ]
    assert saved("monthly_driver_earnings", MONTHLY_EARNINGS_REPORT) == [
        ("P", 1, 30.0),
        ("Q", 1, 30.0),
        ("Q", 2, 40.0),
    ]
    assert saved("january_daily_wait", DAILY_WAIT_REPORT) == [(1, 300.0), (2, 900.0)]
    assert saved("wait_anomalies", DAILY_WAIT_REPORT) == [(2, 900.0)]
    assert saved("shared_routes_top10", "Route string, p int, q int, n int") == [
        ("Alpha to Gamma", 1, 1, 2)
    ]
    assert saved("lost_trips", "business string, month int, pickup string, dropoff string, n int") == [
        ("Q", 2, "known", "unknown", 1)
    ]
    assert saved("unknown_locations", "role string, location int, n int") == [("dropoff", 77, 1)]
    assert saved("od_trip_count", "n int") == [(2,)]
    assert saved("same_area_edge_count", "n int") == [(2,)]
    assert saved("top_routes_by_pay", "Route string, pay double") == [
        ("North to North", 50.0),
        ("North to South", 50.0),
    ]


def test_staging_changes_no_result(spark, tmp_path):
    only = ("--only", "earning_per_mile", "evening_groups", "wait_anomalies")
    plain = run_reports.run(spark, arguments(tmp_path, *only))
    first = [sorted(spark.read.csv(p, header=True).collect()) for p in plain]
    staged = run_reports.run(spark, arguments(tmp_path, "--stage", str(tmp_path / "s"), *only))
    assert [sorted(spark.read.csv(p, header=True).collect()) for p in staged] == first
    assert len(first) == 3


def test_year_as_a_further_key(spark):
    trips = spark.createDataFrame(
        [("P", 1, 1, JAN_1), ("P", 1, 1, JAN_1 - 31536000)],
        "business string, pickup_location int, dropoff_location int, date bigint",
    )
    zones = spark.createDataFrame([(1, "b", "z", "s")], ZONE_SCHEMA)
    mart = Mart.of(trips, zones, year=True)
    report = monthly.monthly_report(mart, monthly.TRIPS, keys=("business", "year", "month"))
    assert sorted(tuple(r) for r in report.collect()) == [("P", 2022, 1, 1), ("P", 2023, 1, 1)]


def test_families_are_taken_once_and_row_tables_go_to_parquet(spark, tmp_path):
    args = arguments(tmp_path, "--row-tables", str(tmp_path / "rows"), "--year", "--stage", str(tmp_path / "s"))
    paths = run_reports.run(spark, args)
    assert len(paths) == 29 and {p.name for p in (tmp_path / "s").iterdir() if p.is_dir()} == {"year=2023"}
    assert spark.read.parquet(str(tmp_path / "rows" / "r1" / "od_trips")).count() == 2
    monthly_rows = spark.read.csv(str(tmp_path / "out" / "r1" / "monthly_report"), header=True)
    assert len(monthly_rows.columns) == 6 and monthly_rows.count() == 3
    mart = Mart.of(spark.createDataFrame([("P", 1, 1, JAN_1, 1.0, 2.0)],
        "business string, pickup_location int, dropoff_location int, date bigint,"
        " rideshare_profit double, driver_total_pay double"),
        spark.createDataFrame([(1, "b", "z", "s")], ZONE_SCHEMA), share=True)
    plans = [r(mart)._jdf.queryExecution().executedPlan().toString()
             for r in (monthly.monthly_trip_count, monthly.monthly_all)]
    assert all("InMemoryTableScan" in p for p in plans) and len(mart.shared) == 1
    mart.release()
    assert not mart.shared


def test_a_bad_checkpoint_folder_stops_the_run_first(spark, tmp_path, monkeypatch):
    def refuse(_):
        raise RuntimeError("no folder")

    monkeypatch.setattr(run_reports, "ensure_checkpoint_dir", refuse)
    with pytest.raises(RuntimeError, match="no folder"):
        run_reports.run(spark, arguments(tmp_path))
    assert not (tmp_path / "out").exists()
