"""The queries as plain SQL over the order tables, written apart from the Spark code."""

from __future__ import annotations

TRIPS = """
trips AS (
  SELECT l.l_returnflag AS business,
         s.s_nationkey AS pickup_location,
         c.c_nationkey AS dropoff_location,
         l.l_quantity AS trip_length,
         CAST(abs(date_diff('day', o.o_orderdate, l.l_shipdate)) AS DOUBLE) AS request_to_pickup,
         l.l_quantity * CAST(60 AS DOUBLE) AS total_ride_time,
         CAST(l.l_linenumber AS DOUBLE) AS on_scene_to_pickup,
         CAST(l.l_linenumber AS DOUBLE) + l.l_quantity * CAST(60 AS DOUBLE) AS on_scene_to_dropoff,
         o.o_orderpriority AS time_of_day,
         CAST(l.l_shipdate AS DATE) AS date,
         l.l_extendedprice AS passenger_fare,
         l.l_extendedprice * (1 - l.l_discount) AS driver_total_pay,
         l.l_extendedprice * (l.l_tax - l.l_discount) AS rideshare_profit,
         (l.l_extendedprice * (1 - l.l_discount)) * CAST(3600 AS DOUBLE)
           / (l.l_quantity * CAST(60 AS DOUBLE)) AS hourly_rate,
         (l.l_extendedprice * (1 - l.l_discount)) / l.l_quantity AS dollars_per_mile
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
zones AS (
  SELECT n.n_nationkey AS id, r.r_name AS Borough, n.n_name AS Zone,
         CASE n.n_nationkey % 3 WHEN 0 THEN 'Yellow' WHEN 1 THEN 'Boro' ELSE 'Airports' END
           AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

ENRICHED = (
    TRIPS
    + """,
enriched AS (
  SELECT t.*, CAST(month(t.date) AS INTEGER) AS month,
         p.Borough AS Pickup_Borough, p.Zone AS Pickup_Zone,
         p.service_zone AS Pickup_service_zone,
         d.Borough AS Dropoff_Borough, d.Zone AS Dropoff_Zone,
         d.service_zone AS Dropoff_service_zone
  FROM trips t
  JOIN zones p ON t.pickup_location = p.id
  JOIN zones d ON t.dropoff_location = d.id
)"""
)

ENRICHED_TYPES = [
    ("business", "string"),
    ("pickup_location", "int"),
    ("dropoff_location", "int"),
    ("trip_length", "double"),
    ("request_to_pickup", "double"),
    ("total_ride_time", "double"),
    ("on_scene_to_pickup", "double"),
    ("on_scene_to_dropoff", "double"),
    ("time_of_day", "string"),
    ("date", "date"),
    ("passenger_fare", "double"),
    ("driver_total_pay", "double"),
    ("rideshare_profit", "double"),
    ("hourly_rate", "double"),
    ("dollars_per_mile", "double"),
    ("Pickup_Borough", "string"),
    ("Pickup_Zone", "string"),
    ("Pickup_service_zone", "string"),
    ("Dropoff_Borough", "string"),
    ("Dropoff_Zone", "string"),
    ("Dropoff_service_zone", "string"),
]


def enriched(select: str) -> str:
    return f"WITH {ENRICHED}\n{select}"


def graph(select: str, *more: str) -> str:
    return f"WITH {', '.join([TRIPS, *more])}\n{select}"


def trip_schema() -> str:
    rows = ", ".join(
        f"({i}, '{name}', '{kind}')" for i, (name, kind) in enumerate(ENRICHED_TYPES)
    )
    counts = ", ".join(f"n.n{i}" for i in range(len(ENRICHED_TYPES)))
    sums = ", ".join(f"count({name}) AS n{i}" for i, (name, _) in enumerate(ENRICHED_TYPES))
    return enriched(
        "SELECT CAST(v.position AS INTEGER) AS position, v.column_name, v.column_type,"
        f" [{counts}][v.position + 1] AS non_null, n.row_count"
        f" FROM (VALUES {rows}) v(position, column_name, column_type),"
        f" (SELECT count(*) AS row_count, {sums} FROM enriched) n"
    )


def top_area(area: str) -> str:
    return enriched(f"""
SELECT {area}, month, trip_count FROM (
  SELECT {area}, month, count(*) AS trip_count,
         row_number() OVER (PARTITION BY month ORDER BY count(*) DESC, {area}) AS place
  FROM enriched GROUP BY {area}, month
) WHERE place <= 5""")


SAME_AREA = """
FROM trips t
JOIN zones a ON t.pickup_location = a.id
JOIN zones b ON t.dropoff_location = b.id
WHERE a.Borough = b.Borough AND a.service_zone = b.service_zone"""

JANUARY_WAIT = """
  SELECT CAST(day(date) AS INTEGER) AS day, avg(request_to_pickup) AS wait
  FROM enriched WHERE month(date) = 1 GROUP BY 1"""

SHARED_ROUTES = """
WITH named AS (
  SELECT s.s_name || ' to ' || c.c_name AS Route, l.l_returnflag AS business
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
a AS (SELECT Route, count(*) AS a_count FROM named WHERE business = 'A' GROUP BY Route),
n AS (SELECT Route, count(*) AS n_count FROM named WHERE business = 'N' GROUP BY Route)
SELECT a.Route, a_count, n_count, a_count + n_count AS total_count
FROM a JOIN n ON a.Route = n.Route
ORDER BY total_count DESC, a.Route LIMIT 10"""

PARSED_LINES = """
SELECT l_returnflag AS business,
       CAST(l_suppkey AS INTEGER) AS pickup_location,
       CAST(l_partkey AS INTEGER) AS dropoff_location,
       l_quantity AS trip_length,
       CAST(l_linenumber AS DOUBLE) AS request_to_pickup,
       l_quantity AS total_ride_time,
       l_tax AS on_scene_to_pickup,
       l_discount AS on_scene_to_dropoff,
       l_linestatus AS time_of_day,
       CAST(epoch(l_shipdate) AS BIGINT) AS date,
       l_extendedprice AS passenger_fare,
       l_quantity AS driver_total_pay,
       l_tax AS rideshare_profit,
       CASE WHEN l_linenumber <> 5 THEN l_tax END AS hourly_rate,
       CASE WHEN l_linenumber <> 5 THEN l_discount END AS dollars_per_mile
FROM lineitem WHERE l_linenumber NOT IN (4, 6, 7)"""

PARSED_ZONE_LINES = """
SELECT CAST(c_custkey AS INTEGER) AS LocationID,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '' ELSE c_mktsegment END AS Borough,
       c_name AS Zone,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '' ELSE CAST(c_nationkey AS VARCHAR) END
         AS service_zone
FROM customer WHERE c_mktsegment <> 'MACHINERY'"""


PARSED_ZONE_LINES_CSV = """
SELECT CAST(c_custkey AS INTEGER) AS LocationID,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '' ELSE c_mktsegment END AS Borough,
       c_name || CASE WHEN c_mktsegment = 'MACHINERY' THEN ', annex' ELSE '' END AS Zone,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '' ELSE CAST(c_nationkey AS VARCHAR) END
         AS service_zone
FROM customer"""

PARTIES = """
trips AS (
  SELECT 'pickup:' || l.l_suppkey AS pickup_location, 'dropoff:' || o.o_custkey AS dropoff_location
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
zones AS (
  SELECT 'pickup:' || s_suppkey AS id, CAST(s_nationkey AS VARCHAR) AS Borough, s_name AS Zone,
         '' AS service_zone FROM supplier
  UNION ALL
  SELECT 'dropoff:' || c_custkey, CAST(c_nationkey AS VARCHAR), c_name, c_mktsegment FROM customer
)"""


# Trip lines that parse, and the zones whose lines do.
TEXT_TRIPS = """
t AS (
  SELECT l_returnflag AS business, CAST(month(l_shipdate) AS INTEGER) AS month,
         CAST(l_suppkey AS INTEGER) AS p, CAST(l_partkey AS INTEGER) AS d
  FROM lineitem WHERE l_linenumber NOT IN (4, 6, 7)
),
z AS (SELECT c_custkey AS id FROM customer WHERE c_mktsegment <> 'MACHINERY')"""

LOST_TRIPS = f"""
WITH {TEXT_TRIPS}
SELECT * FROM (
  SELECT business, month,
         CASE WHEN p IS NULL THEN 'missing' WHEN p IN (SELECT id FROM z) THEN 'known' ELSE 'unknown' END AS pickup,
         CASE WHEN d IS NULL THEN 'missing' WHEN d IN (SELECT id FROM z) THEN 'known' ELSE 'unknown' END AS dropoff,
         count(*) AS trip_count
  FROM t GROUP BY ALL
) WHERE pickup <> 'known' OR dropoff <> 'known'"""

UNKNOWN_LOCATIONS = f"""
WITH {TEXT_TRIPS}
SELECT role, location, count(*) AS trip_count
FROM (SELECT 'pickup' AS role, p AS location FROM t UNION ALL SELECT 'dropoff', d FROM t) e
WHERE NOT EXISTS (SELECT 1 FROM z WHERE z.id = e.location)
GROUP BY 1, 2"""


def pagerank(
    rounds: int = 40, reset: float = 0.17, tol: float = 0.01, tables: str = TRIPS
) -> str:
    """Rounds written out one by one; those after the end change nothing."""
    keep = f"(1 - CAST({reset} AS DOUBLE))"
    parts = [
        """pairs AS MATERIALIZED (
  SELECT t.pickup_location AS src, t.dropoff_location AS dst, CAST(count(*) AS DOUBLE) AS w
  FROM trips t
  WHERE t.pickup_location IN (SELECT id FROM zones)
    AND t.dropoff_location IN (SELECT id FROM zones)
  GROUP BY 1, 2)""",
        """shares AS MATERIALIZED (
  SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS p FROM pairs)""",
        f"""r0 AS MATERIALIZED (
  SELECT id, CAST({reset} AS DOUBLE) AS rank, CAST({reset} AS DOUBLE) AS delta FROM zones)""",
    ]
    for i in range(1, rounds + 1):
        parts.append(f"""r{i} AS MATERIALIZED (
  SELECT v.id, v.rank + coalesce(m.gain, 0) AS rank, m.gain AS delta
  FROM r{i - 1} v LEFT JOIN (
    SELECT e.dst, {keep} * sum(u.delta * e.p) AS gain
    FROM r{i - 1} u JOIN shares e ON u.id = e.src
    WHERE u.delta > {tol} GROUP BY e.dst
  ) m ON v.id = m.dst)""")
    return "WITH " + ", ".join([tables, *parts]) + (
        f"""\nSELECT id, round(rank * (SELECT count(*) / sum(rank) FROM r{rounds}), 6) AS pagerank
FROM r{rounds} ORDER BY 2 DESC, id LIMIT 5"""
    )


def statements() -> dict[str, str]:
    return {
        "enriched_trips": enriched("SELECT * EXCLUDE (month) FROM enriched"),
        "trip_row_count": enriched("SELECT count(*) AS row_count FROM enriched"),
        "trip_schema": trip_schema(),
        "lost_trips": LOST_TRIPS,
        "unknown_locations": UNKNOWN_LOCATIONS,
        "parsed_lines": PARSED_LINES,
        "parsed_zone_lines": PARSED_ZONE_LINES,
        "monthly_trip_count": enriched(
            "SELECT business, month, count(*) AS trip_count FROM enriched GROUP BY 1, 2"
        ),
        "monthly_platform_profit": enriched(
            "SELECT business, month, CAST(sum(CAST(rideshare_profit AS DECIMAL(28, 4))) AS DOUBLE) AS platform_profit"
            " FROM enriched GROUP BY 1, 2"
        ),
        "monthly_driver_earnings": enriched(
            "SELECT business, month, CAST(sum(CAST(driver_total_pay AS DECIMAL(28, 4))) AS DOUBLE) AS driver_earnings"
            " FROM enriched GROUP BY 1, 2"
        ),
        "monthly_report": enriched(
            "SELECT business, month, count(*) AS trip_count,"
            " CAST(sum(CAST(rideshare_profit AS DECIMAL(28, 4))) AS DOUBLE) AS platform_profit,"
            " CAST(sum(CAST(driver_total_pay AS DECIMAL(28, 4))) AS DOUBLE) AS driver_earnings FROM enriched GROUP BY 1, 2"
        ),
        "provider_series": enriched(
            "SELECT business, month, count(*) AS trip_count,"
            " CAST(sum(CAST(rideshare_profit AS DECIMAL(28, 4))) AS DOUBLE) AS platform_profit,"
            " CAST(sum(CAST(driver_total_pay AS DECIMAL(28, 4))) AS DOUBLE) AS driver_earnings FROM enriched"
            " WHERE business = 'A' GROUP BY 1, 2 ORDER BY month"
        ),
        "pickup_boroughs": enriched("SELECT DISTINCT Pickup_Borough FROM enriched"),
        "top_pickup_per_month": top_area("Pickup_Zone"),
        "top_dropoff_per_month": top_area("Dropoff_Zone"),
        "top_routes_by_pay": enriched(
            "SELECT Pickup_Zone || ' to ' || Dropoff_Zone AS Route,"
            " CAST(sum(CAST(driver_total_pay AS DECIMAL(28, 4))) AS DOUBLE) AS total_profit FROM enriched"
            " GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30"
        ),
        "avg_pay_by_time_of_day": enriched(
            "SELECT time_of_day, round(avg(driver_total_pay), 6) AS average_drive_total_pay"
            " FROM enriched GROUP BY 1"
        ),
        "avg_length_by_time_of_day": enriched(
            "SELECT time_of_day, round(avg(trip_length), 6) AS average_trip_length"
            " FROM enriched GROUP BY 1"
        ),
        "earning_per_mile": enriched(
            "SELECT time_of_day,"
            " round(avg(driver_total_pay) / avg(trip_length), 6) AS average_earning_per_mile"
            " FROM enriched GROUP BY 1"
        ),
        "january_daily_wait": enriched(
            f"SELECT day, round(wait, 6) AS average_waiting_time FROM ({JANUARY_WAIT})"
        ),
        "january_daily_value": (
            "SELECT CAST(day(ts) AS INTEGER) AS day, round(avg(value), 6) AS average_value"
            " FROM events WHERE month(ts) = 1 GROUP BY 1"
        ),
        "wait_anomalies": enriched(
            f"SELECT day, round(wait, 6) AS average_waiting_time FROM ({JANUARY_WAIT})"
            " WHERE wait > 850"
        ),
        "sparse_groups": enriched(
            "SELECT Pickup_Borough, time_of_day, count(*) AS trip_count FROM enriched"
            " GROUP BY 1, 2 HAVING count(*) > 0 AND count(*) < 2000"
        ),
        "evening_groups": enriched(
            "SELECT Pickup_Borough, time_of_day, count(*) AS trip_count FROM enriched"
            " WHERE time_of_day = '2-HIGH' GROUP BY 1, 2"
        ),
        "od_trips": enriched(
            "SELECT Pickup_Borough, Dropoff_Borough, Pickup_Zone FROM enriched"
            " WHERE Pickup_Borough = 'AFRICA' AND Dropoff_Borough = 'ASIA'"
        ),
        "od_trip_count": enriched(
            "SELECT count(*) AS trip_count FROM enriched"
            " WHERE Pickup_Borough = 'AFRICA' AND Dropoff_Borough = 'ASIA'"
        ),
        "shared_routes_top10": SHARED_ROUTES,
        "graph_vertices": graph("SELECT id, Borough, Zone, service_zone FROM zones"),
        "graph_edges": graph(
            "SELECT pickup_location AS src, dropoff_location AS dst FROM trips"
        ),
        "graph_triplets": graph("""
SELECT DISTINCT a.id AS src_id, a.Borough AS src_Borough, a.Zone AS src_Zone,
       a.service_zone AS src_service_zone,
       t.pickup_location AS edge_src, t.dropoff_location AS edge_dst,
       b.id AS dst_id, b.Borough AS dst_Borough, b.Zone AS dst_Zone,
       b.service_zone AS dst_service_zone
FROM trips t JOIN zones a ON t.pickup_location = a.id JOIN zones b ON t.dropoff_location = b.id"""),
        "same_area_edges": graph(
            f"SELECT a.id AS src_id, b.id AS dst_id, a.Borough, a.service_zone {SAME_AREA}"
        ),
        "same_area_edge_count": graph(f"SELECT count(*) AS edge_count {SAME_AREA}"),
        "pagerank_top5": pagerank(),
        "od_trip_preview": enriched(
            "SELECT Pickup_Borough, Dropoff_Borough, Pickup_Zone FROM enriched"
            " WHERE Pickup_Borough = 'AFRICA' AND Dropoff_Borough = 'ASIA'"
            " ORDER BY 1, 2, 3 LIMIT 10"
        ),
        "parsed_zone_lines_csv": PARSED_ZONE_LINES_CSV,
        "party_vertices": f"WITH {PARTIES}\nSELECT id, Borough, Zone, service_zone FROM zones",
        "party_triplets": f"""WITH {PARTIES}
SELECT DISTINCT a.id AS src_id, a.Borough AS src_Borough, a.Zone AS src_Zone,
       a.service_zone AS src_service_zone,
       t.pickup_location AS edge_src, t.dropoff_location AS edge_dst,
       b.id AS dst_id, b.Borough AS dst_Borough, b.Zone AS dst_Zone,
       b.service_zone AS dst_service_zone
FROM trips t JOIN zones a ON t.pickup_location = a.id JOIN zones b ON t.dropoff_location = b.id""",
        "party_same_area_count": f"""WITH {PARTIES}
SELECT CAST(count(*) AS BIGINT) AS edge_count
FROM trips t JOIN zones a ON t.pickup_location = a.id JOIN zones b ON t.dropoff_location = b.id
WHERE a.Borough = b.Borough""",
        "party_pagerank_top5": pagerank(tables=PARTIES),
    }
