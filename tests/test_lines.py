from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tripmart.functions import field_count
from tripmart.schemas import TRIP_SCHEMA, ZONE_SCHEMA
from tripmart.sources import drop_header, keep_arity, parse_lines, read_trips, read_zones
from tripmart.sources import strip_quotes

ZONE_LINES = [
    "LocationID,Borough,Zone,service_zone",
    '1,"Queens","Astoria","Boro"',
    '2,"Bronx","X, Y","Boro"',
    '3,"Queens","short"',
    '4,"Q","Z","B","extra"',
    "5,,Z,B",
    "LocationID,Borough,Zone,service_zone",
    "6,a,b,",
]

TRIP = "P,1,2,3.5,60,600,5,605,evening,1672531200,20.5,15.25,-1.5,91.5,4.36"
TRIP_HEADER = ",".join(TRIP_SCHEMA.fieldNames())


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)


def test_strict_split_keeps_arity_and_strips_quotes(spark):
    parsed = parse_lines(lines(spark, ZONE_LINES), ZONE_SCHEMA, quoted=True)
    assert rows(parsed) == [
        (1, "Queens", "Astoria", "Boro"),
        (5, "", "Z", "B"),
        (6, "a", "b", ""),
    ]
    assert parsed.schema == ZONE_SCHEMA


def test_csv_mode_keeps_quoted_commas(spark):
    parsed = parse_lines(lines(spark, ZONE_LINES), ZONE_SCHEMA, mode="csv")
    assert rows(parsed) == [
        (1, "Queens", "Astoria", "Boro"),
        (2, "Bronx", "X, Y", "Boro"),
        (5, "", "Z", "B"),
        (6, "a", "b", ""),
    ]


def test_given_header_leaves_the_first_line_in_place(spark):
    body = ["1,a,b,c", "x,y,z,w", "1,a,b,c"]
    assert parse_lines(lines(spark, body), ZONE_SCHEMA).count() == 1
    assert parse_lines(lines(spark, body), ZONE_SCHEMA, header="x,y,z,w").count() == 2


def test_no_lines_at_all(spark):
    assert rows(parse_lines(lines(spark, ["only,three,fields"]), ZONE_SCHEMA)) == []
    assert drop_header(lines(spark, [])).count() == 0


def test_numbers_that_do_not_parse_are_null(spark):
    bad = TRIP.replace(",20.5,", ",,").replace(",91.5,", ",n/a,").replace("P,1,", "P,1.5,")
    row = parse_lines(lines(spark, [TRIP_HEADER, bad]), TRIP_SCHEMA).first()
    assert (row.passenger_fare, row.hourly_rate, row.pickup_location) == (None, None, None)
    assert (row.dropoff_location, row.date, row.rideshare_profit) == (2, 1672531200, -1.5)


def test_float32_narrows_measures_only(spark):
    wide = parse_lines(lines(spark, [TRIP_HEADER, TRIP]), TRIP_SCHEMA)
    narrow = parse_lines(lines(spark, [TRIP_HEADER, TRIP]), TRIP_SCHEMA, float32=True)
    assert wide.schema == TRIP_SCHEMA
    assert dict(narrow.dtypes)["dollars_per_mile"] == "float"
    assert dict(narrow.dtypes)["date"] == "bigint"
    assert narrow.first().dollars_per_mile != wide.first().dollars_per_mile


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        parse_lines(lines(spark, []), ZONE_SCHEMA, mode="tabs")


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='a,"é 1', max_size=12), min_size=1, max_size=30))
def test_arity_is_that_of_a_plain_split(spark, values):
    counted = lines(spark, values).select("value", field_count("value").alias("n"))
    assert all(r.n == len(r.value.split(",")) for r in counted.collect())
    kept = [r.value for r in keep_arity(lines(spark, values), 3).collect()]
    assert sorted(kept) == sorted(v for v in values if v.count(",") == 2)


def test_strip_quotes_of_chosen_columns(spark):
    one = spark.createDataFrame([('"a"', '"b"')], "x string, y string")
    assert rows(strip_quotes(one)) == [("a", "b")]
    assert rows(strip_quotes(one, ["y"])) == [('"a"', "b")]


def test_files(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("\n".join(ZONE_LINES) + "\n")
    (tmp_path / "trips.csv").write_text("\n".join([TRIP_HEADER, TRIP, "broken", TRIP]) + "\n")
    zones = read_zones(spark, str(tmp_path / "zones.csv"))
    trips = read_trips(spark, str(tmp_path / "trips.csv"))
    assert [r.LocationID for r in zones.orderBy("LocationID").collect()] == [1, 5, 6]
    assert trips.count() == 2
    assert "Python" not in plan(trips.groupBy("business").agg(F.sum("driver_total_pay")))


@pytest.mark.parametrize("mode", ["strict_split", "csv"])
def test_the_header_is_the_first_kept_line(spark, mode):
    preamble = ["Zones of the city, as of today", *ZONE_LINES]
    got = parse_lines(lines(spark, preamble), ZONE_SCHEMA, mode=mode, quoted=True)
    assert rows(got) == rows(parse_lines(lines(spark, ZONE_LINES), ZONE_SCHEMA, mode=mode, quoted=True))
    assert parse_lines(lines(spark, ["just, three, fields"]), ZONE_SCHEMA, mode=mode).count() == 0
