"""The registered queries as SQL over the same tables, for an independent check."""

from __future__ import annotations

TRIPS = """
numbered AS (
    SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events
),
trips AS (
    SELECT event_id AS trip_id,
           ts AS tpep_pickup_datetime,
           ts + to_minutes(k) AS tpep_dropoff_datetime,
           user_id % 30 AS PULocationID,
           CASE WHEN k % 7 <> 6 THEN CAST(k % 7 AS DOUBLE) END AS passenger_count,
           CASE WHEN k % 50 = 49 THEN CAST(-1 AS DOUBLE) ELSE CAST(k AS DOUBLE) / 10 END AS trip_distance,
           CASE WHEN event_type = 'error' AND k % 10 = 0 THEN -value ELSE value END AS fare_amount,
           CASE WHEN event_type = 'purchase' THEN value * CAST(0.2 AS DOUBLE)
                ELSE CAST(0 AS DOUBLE) END AS tip_amount
    FROM numbered
)"""

CENTROIDS = """
centroids AS (
    SELECT n_nationkey AS LocationID,
           CAST(40.5 AS DOUBLE) + (n_nationkey % 20) * CAST(0.015 AS DOUBLE) AS latitude,
           CAST(-74.2 AS DOUBLE) + (n_nationkey % 20) * CAST(0.02 AS DOUBLE) AS longitude
    FROM nation
)"""

ZONES = """
zones AS (
    SELECT n_nationkey AS LocationID, n_name AS Zone, r_name AS Borough
    FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

LOCATED = """
located AS (
    SELECT trips.*, latitude AS pickup_latitude, longitude AS pickup_longitude
    FROM trips LEFT JOIN centroids ON PULocationID = LocationID
)"""

DIRTY = """
dirty AS (
    SELECT * FROM located UNION ALL SELECT * FROM located WHERE tip_amount > 0
)"""

REPEATED = """
repeated AS (
    SELECT * FROM trips UNION ALL SELECT * FROM trips WHERE tip_amount > 0
)"""


def seconds(start: str, end: str) -> str:
    return f"(CAST(floor(epoch({end})) AS BIGINT) - CAST(floor(epoch({start})) AS BIGINT))"


TRIP_SECONDS = seconds("tpep_pickup_datetime", "tpep_dropoff_datetime")


def times_ok(hours: float) -> str:
    return f"(tpep_pickup_datetime < tpep_dropoff_datetime AND {TRIP_SECONDS} / 3600 <= {hours})"


VALUES_OK = "(passenger_count >= 0 AND trip_distance >= 0 AND fare_amount > 0)"
DISTRICT_OK = """(pickup_latitude BETWEEN CAST(40.53 AS DOUBLE) AND CAST(40.74 AS DOUBLE)
    AND pickup_longitude BETWEEN CAST(-74.15 AS DOUBLE) AND CAST(-73.86 AS DOUBLE))"""

VALID = f"valid AS (SELECT * FROM trips WHERE {times_ok(24)} AND {VALUES_OK})"

CALENDAR = """
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_dayofweek"""


def featured(source: str, name: str = "featured") -> str:
    """CTEs: the source with time and revenue columns and the high-value flag."""
    return f"""
{name}_plain AS (
    SELECT *, {CALENDAR},
           {TRIP_SECONDS} / 60 AS trip_duration_minutes,
           fare_amount + tip_amount AS total_revenue
    FROM {source}
),
{name} AS (
    SELECT *, CASE WHEN total_revenue >= (SELECT quantile_disc(total_revenue, 0.75) FROM {name}_plain)
                   THEN 1 ELSE 0 END AS is_high_value
    FROM {name}_plain
)"""


FEATURED = featured("valid")


def location_stats(source: str) -> str:
    return f"""
stats AS (
    SELECT PULocationID,
           count(*) AS trip_count,
           CAST(sum(CAST(fare_amount AS DECIMAL(18,4))) AS DOUBLE) / count(fare_amount) AS avg_fare,
           CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE) AS total_revenue,
           avg(trip_distance) AS avg_distance,
           avg(trip_duration_minutes) AS avg_duration,
           CAST(sum(is_high_value) AS BIGINT) AS high_value_trips,
           CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE) * count(*) / 1000000 AS profit_score
    FROM {source} GROUP BY PULocationID
)"""


def stats_columns() -> str:
    names = ["avg_fare", "total_revenue", "avg_distance", "avg_duration", "profit_score"]
    # Rounded as decimals: multiplying a double by 10,000 first moves exact ties to either side.
    doubles = ", ".join(f"CAST(round(CAST({name} AS DECIMAL(38,10)), 4) AS DOUBLE) AS {name}" for name in names)
    return f"PULocationID, trip_count, high_value_trips, {doubles}"


CENTERS = [(0, 40.5, -74.2), (1, 40.575, -74.1), (2, 40.65, -74.0), (3, 40.725, -73.9)]
CENTER_ROWS = ", ".join(
    f"({c}, CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))" for c, lat, lon in CENTERS
)
CENTER_TABLE = f"""
centers AS (
    SELECT CAST(cluster AS INTEGER) AS cluster, latitude, longitude
    FROM (VALUES {CENTER_ROWS}) AS c(cluster, latitude, longitude)
)"""

DISTANCES = """
distances AS (
    SELECT p.LocationID, c.cluster,
           (p.latitude - c.latitude) * (p.latitude - c.latitude)
           + (p.longitude - c.longitude) * (p.longitude - c.longitude) AS distance
    FROM centroids p, centers c
),
zone_clusters AS (
    SELECT LocationID, cluster, distance
    FROM (SELECT *, row_number() OVER (PARTITION BY LocationID ORDER BY distance, cluster) AS r
          FROM distances)
    WHERE r = 1
)"""

CLUSTERED = f"""
clustered AS (
    SELECT t.*, {CALENDAR},
           {TRIP_SECONDS} / 60 AS trip_duration_minutes,
           fare_amount + tip_amount AS total_revenue,
           p.latitude, p.longitude, z.cluster, z.distance
    FROM valid t JOIN centroids p ON t.PULocationID = p.LocationID
    JOIN zone_clusters z ON z.LocationID = p.LocationID
)"""

METRICS = """
metrics AS (
    SELECT cluster,
           count(*) AS trip_count,
           CAST(sum(CAST(fare_amount AS DECIMAL(18,4))) AS DOUBLE) / count(fare_amount) AS avg_fare,
           CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE) / count(total_revenue) AS avg_revenue,
           CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE) AS total_revenue,
           avg(trip_duration_minutes) AS avg_duration_minutes,
           avg(pickup_hour) AS avg_hour
    FROM clustered GROUP BY cluster
)"""
METRIC_COLUMNS = """cluster, trip_count, round(avg_fare, 4) AS avg_fare,
    round(avg_revenue, 4) AS avg_revenue, round(total_revenue, 4) AS total_revenue,
    round(avg_duration_minutes, 4) AS avg_duration_minutes, round(avg_hour, 4) AS avg_hour"""

ORDERS = f"""
order_trips AS (
    SELECT o_orderdate AS tpep_pickup_datetime,
           l_shipdate AS tpep_dropoff_datetime,
           l_suppkey AS PULocationID,
           l_quantity AS passenger_count,
           l_quantity AS trip_distance,
           l_extendedprice AS fare_amount,
           l_extendedprice * l_tax AS tip_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
valid_orders AS (SELECT * FROM order_trips WHERE {times_ok(90 * 24)} AND {VALUES_OK})"""

BASE = [TRIPS, VALID]
ON_CLUSTERS = [TRIPS, VALID, CENTROIDS, CENTER_TABLE, DISTANCES, CLUSTERED]
ON_METRICS = [*ON_CLUSTERS, METRICS]
ON_STATS = [TRIPS, VALID, FEATURED, location_stats("featured")]


def with_ctes(ctes: list[str], select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def ranked(source: str, columns: str, metric: str, key: str, n: int) -> str:
    order = f"round({metric}, 6) DESC NULLS LAST, {key}"
    return f"""
SELECT {columns}, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM {source})
WHERE rank <= {n}"""


def pattern(source: str, key: str, metric: str, n: int, by: str, extra: str = "") -> str:
    return f"""
SELECT {key}, {by}, count(*) AS trips{extra}
FROM {source}
WHERE {key} IN (SELECT {key} FROM {source} GROUP BY {key}
                ORDER BY round({metric}, 6) DESC, {key} LIMIT {n})
GROUP BY {key}, {by}"""


WEEKDAY = """, ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][pickup_dayofweek] AS weekday"""


def cleaning_steps(source: str, rules: list[tuple[str, str]], distinct: str) -> str:
    """CTE ``steps`` with one row of counts: total, one per rule, kept."""
    case = " ".join(f"WHEN NOT coalesce({rule}, FALSE) THEN '{name}'" for name, rule in rules)
    counts = ", ".join(f"count(*) FILTER (WHERE reason = '{name}') AS {name}" for name, _ in rules)
    return f"""
tagged AS (SELECT *, CASE {case} END AS reason FROM {source}),
steps AS (
    SELECT count(*) AS total, {counts},
           (SELECT count(*) FROM (SELECT DISTINCT {distinct} FROM tagged WHERE reason IS NULL)) AS kept
    FROM tagged
)"""


def report(names: list[str]) -> str:
    rows, rows_in = [], "total"
    for i, name in enumerate([*names, "duplicates"], start=1):
        removed = name if name != "duplicates" else f"{rows_in} - kept"
        rows.append(
            f"SELECT CAST({i} AS INTEGER) AS step, '{name}' AS rule, {rows_in} AS rows_in, "
            f"{removed} AS rows_removed, round(({removed}) / ({rows_in}) * 100, 4) AS removed_pct FROM steps"
        )
        rows_in = f"{rows_in} - {name}"
    return "\nUNION ALL ".join(rows)


DIRTY_RULES = [("coordinates", DISTRICT_OK), ("times", times_ok(24)), ("values", VALUES_OK)]
ORDER_RULES = [("times", times_ok(90 * 24)), ("values", VALUES_OK)]
DIRTY_COLUMNS = """trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, passenger_count,
    trip_distance, fare_amount, tip_amount, pickup_latitude, pickup_longitude"""
ON_DIRTY = [TRIPS, CENTROIDS, LOCATED, DIRTY]

NUMERIC = ["trip_id", "PULocationID", "passenger_count", "trip_distance", "fare_amount", "tip_amount",
           "pickup_latitude", "pickup_longitude"]
TIMES = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
LINE_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax"]
LINE_OTHER = ["l_returnflag", "l_linestatus", "l_shipdate"]


def null_row(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) AS null_count,
    round(count(*) FILTER (WHERE {name} IS NULL) / count(*) * 100, 4) AS null_pct FROM {source}"""


def numeric_row(name: str, source: str, nulls: bool = False) -> str:
    quartiles = ", ".join(
        f"round(quantile_disc(CAST({name} AS DOUBLE), {p}), 4) AS {q}"
        for q, p in [("p25", 0.25), ("p50", 0.5), ("p75", 0.75)]
    )
    missing = f"""count(*) FILTER (WHERE {name} IS NULL) AS null_count,
    round(count(*) FILTER (WHERE {name} IS NULL) / count(*) * 100, 4) AS null_pct,""" if nulls else ""
    return f"""SELECT '{name}' AS column_name, {missing}
    round(CAST(min({name}) AS DOUBLE), 4) AS min, round(CAST(max({name}) AS DOUBLE), 4) AS max,
    round(avg({name}), 4) AS mean, {quartiles} FROM {source}"""


def other_row(name: str, source: str) -> str:
    blank = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in ["min", "max", "mean", "p25", "p50", "p75"])
    return null_row(name, source).replace(" FROM ", f", {blank} FROM ")


TEXT_TIMES = """
    strftime(tpep_pickup_datetime, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(tpep_pickup_datetime) % 1000000 <> 0
        THEN strftime(tpep_pickup_datetime, '.%f') ELSE '' END AS tpep_pickup_datetime,
    strftime(tpep_dropoff_datetime, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(tpep_dropoff_datetime) % 1000000 <> 0
        THEN strftime(tpep_dropoff_datetime, '.%f') ELSE '' END AS tpep_dropoff_datetime"""
TRIP_TEXT = f"""SELECT trip_id, {TEXT_TIMES}, PULocationID, passenger_count, trip_distance,
    fare_amount, tip_amount FROM trips"""

SILHOUETTE = """
sums AS (
    SELECT cluster, count(*) AS n, sum(latitude) AS sx, sum(longitude) AS sy,
           sum(latitude * latitude + longitude * longitude) AS sq
    FROM clustered GROUP BY cluster
),
means AS (
    SELECT t.trip_id, t.cluster AS own, s.cluster AS other, s.n,
           (t.latitude * t.latitude + t.longitude * t.longitude) + s.sq / s.n
           - 2 * (t.latitude * s.sx + t.longitude * s.sy) / s.n AS mean_distance
    FROM clustered t, sums s
),
sides AS (
    SELECT trip_id,
           max(CASE WHEN own = other THEN n END) AS n,
           max(CASE WHEN own = other THEN mean_distance * n / nullif(n - 1, 0) END) AS a,
           min(CASE WHEN own <> other THEN mean_distance END) AS b
    FROM means GROUP BY trip_id
),
score AS (
    SELECT count(*) AS n_rows,
           avg(CASE WHEN n <= 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END) AS s
    FROM sides
)"""

# Bucket of a trip's key among a million, as the sampling functions find it.
BUCKET = "CAST('0x' || substr(md5('42|' || event_id), 1, 12) AS BIGINT) % 1000000"

# Every point of the test part against every other, with the trips at each.
HELD_OUT = f"""
held AS (
    SELECT latitude, longitude, cluster, count(*) AS w FROM clustered JOIN events ON trip_id = event_id
    WHERE {BUCKET} >= 800000 GROUP BY latitude, longitude, cluster
),
means AS (
    SELECT p.latitude, p.longitude, p.cluster AS own, q.cluster AS other, p.w, sum(q.w) AS n,
           sum(q.w * sqrt((p.latitude - q.latitude) * (p.latitude - q.latitude)
                          + (p.longitude - q.longitude) * (p.longitude - q.longitude))) AS far
    FROM held p, held q GROUP BY p.latitude, p.longitude, p.cluster, q.cluster, p.w
),
sides AS (
    SELECT w, max(CASE WHEN own = other THEN n END) AS n,
           max(CASE WHEN own = other THEN far / nullif(n - 1, 0) END) AS a,
           min(CASE WHEN own <> other THEN far / n END) AS b
    FROM means GROUP BY latitude, longitude, own, w
),
score AS (
    SELECT CAST(sum(w) AS BIGINT) AS n_rows,
           sum(w * CASE WHEN n <= 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END) / sum(w) AS s
    FROM sides
)"""

ORACLES: dict[str, str] = {
    "scan_parquet": "SELECT * FROM events",
    "write_roundtrip": with_ctes([TRIPS], "SELECT * FROM trips"),
    "dataset_info": with_ctes([TRIPS], """
SELECT count(*) AS row_count, CAST(8 AS INTEGER) AS column_count,
       'trip_id,tpep_pickup_datetime,tpep_dropoff_datetime,PULocationID,passenger_count,'
       || 'trip_distance,fare_amount,tip_amount' AS columns
FROM trips"""),
    "trip_json": with_ctes([TRIPS], TRIP_TEXT),
    "clean_coords": with_ctes([TRIPS, CENTROIDS, LOCATED], f"SELECT * FROM located WHERE {DISTRICT_OK}"),
    "clean_times": with_ctes([TRIPS], f"SELECT * FROM trips WHERE {times_ok(1.5)}"),
    "clean_values": with_ctes([TRIPS], f"SELECT * FROM trips WHERE {VALUES_OK}"),
    "clean_values_capped": with_ctes([TRIPS], """
SELECT * FROM trips
WHERE passenger_count >= 1 AND trip_distance >= 0.5 AND fare_amount >= 5 AND fare_amount <= 100"""),
    "clean_values_fare_only": with_ctes([TRIPS], """
SELECT * EXCLUDE (trip_distance) FROM trips
WHERE passenger_count >= 0 AND fare_amount > 0 AND fare_amount <= 500"""),
    "dedup_all": with_ctes([TRIPS, REPEATED], "SELECT DISTINCT * FROM repeated"),
    "dedup_key": with_ctes([TRIPS, REPEATED], """
SELECT * EXCLUDE (r) FROM (
    SELECT *, row_number() OVER (PARTITION BY PULocationID, passenger_count ORDER BY trip_id) AS r
    FROM repeated)
WHERE r = 1"""),
    "clean_trips": with_ctes(ON_DIRTY, f"""
SELECT DISTINCT * FROM dirty WHERE {DISTRICT_OK} AND {times_ok(24)} AND {VALUES_OK}"""),
    "clean_report": with_ctes(
        [*ON_DIRTY, cleaning_steps("dirty", DIRTY_RULES, DIRTY_COLUMNS)],
        report([name for name, _ in DIRTY_RULES]),
    ),
    "clean_summary": with_ctes([*ON_DIRTY, cleaning_steps("dirty", DIRTY_RULES, DIRTY_COLUMNS)], """
SELECT total AS initial_row_count, kept AS cleaned_row_count, total - kept AS rows_removed,
       round((total - kept) / total * 100, 4) AS removal_pct, round(kept / total * 100, 4) AS retention_pct
FROM steps"""),
    "order_clean_report": with_ctes([
        """order_trips AS (
    SELECT l_orderkey, l_linenumber, o_orderdate AS tpep_pickup_datetime,
           l_shipdate AS tpep_dropoff_datetime, l_suppkey AS PULocationID,
           l_quantity AS passenger_count, l_quantity AS trip_distance,
           l_extendedprice AS fare_amount, l_extendedprice * l_tax AS tip_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)""",
        cleaning_steps("order_trips", ORDER_RULES, """l_orderkey, l_linenumber, tpep_pickup_datetime,
            tpep_dropoff_datetime, PULocationID, passenger_count, trip_distance, fare_amount, tip_amount"""),
    ], report([name for name, _ in ORDER_RULES])),
    "quality_nulls": with_ctes(
        ON_DIRTY, "\nUNION ALL ".join(null_row(name, "dirty") for name in [*NUMERIC, *TIMES])
    ),
    "quality_numeric": with_ctes(
        ON_DIRTY, "\nUNION ALL ".join(numeric_row(name, "dirty") for name in NUMERIC)
    ),
    "quality_profile": "\nUNION ALL ".join(
        [numeric_row(name, "lineitem", nulls=True) for name in LINE_NUMERIC]
        + [other_row(name, "lineitem") for name in LINE_OTHER]
    ),
    "drop_null_features": with_ctes([TRIPS, CENTROIDS, LOCATED], """
SELECT * FROM located WHERE pickup_latitude IS NOT NULL AND pickup_longitude IS NOT NULL
    AND fare_amount IS NOT NULL AND passenger_count IS NOT NULL"""),
    "temporal_features": with_ctes([TRIPS], f"""
SELECT trip_id, {CALENDAR},
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
       CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
       CAST(dayofweek(tpep_pickup_datetime) IN (0, 6) AS INTEGER) AS is_weekend,
       CAST((hour(tpep_pickup_datetime) BETWEEN 7 AND 9 OR hour(tpep_pickup_datetime) BETWEEN 17 AND 19)
            AND dayofweek(tpep_pickup_datetime) BETWEEN 1 AND 5 AS INTEGER) AS is_rush_hour
FROM trips"""),
    "trip_duration": with_ctes([TRIPS], f"""
SELECT trip_id, {TRIP_SECONDS} / 60 AS trip_duration_minutes FROM trips"""),
    "revenue_features": with_ctes([TRIPS], f"""
SELECT trip_id, fare_amount + tip_amount AS total_revenue,
       CASE WHEN {TRIP_SECONDS} > 0 THEN (fare_amount + tip_amount) / ({TRIP_SECONDS} / 60)
            ELSE CAST(0 AS DOUBLE) END AS revenue_per_minute
FROM trips"""),
    "high_value_flag": with_ctes([*BASE, FEATURED], """
SELECT trip_id, CAST(is_high_value AS INTEGER) AS is_high_value FROM featured"""),
    "location_vector": with_ctes([TRIPS, CENTROIDS, LOCATED], """
SELECT trip_id, pickup_latitude AS x, pickup_longitude AS y FROM located
WHERE pickup_latitude <> 0 AND pickup_longitude <> 0"""),
    "feature_vector": with_ctes([TRIPS], """
SELECT CAST(3 AS INTEGER) AS dimensions, fare_amount AS fare, tip_amount AS tip, trip_distance AS distance
FROM trips"""),
    "zone_enrich": with_ctes([TRIPS, ZONES], """
SELECT trip_id, PULocationID, fare_amount, zones.* FROM trips LEFT JOIN zones ON PULocationID = LocationID"""),
    "centroid_map": with_ctes([*BASE, CENTROIDS], """
SELECT trip_id, PULocationID, fare_amount, latitude, longitude
FROM valid JOIN centroids ON PULocationID = LocationID"""),
    "location_stats": with_ctes(ON_STATS, f"SELECT {stats_columns()} FROM stats"),
    "clean_location_stats": with_ctes([
        TRIPS,
        REPEATED,
        f"valid AS (SELECT DISTINCT * FROM repeated WHERE {times_ok(24)} AND {VALUES_OK})",
        FEATURED,
        location_stats("featured"),
        ZONES,
        f"best AS ({ranked('stats', stats_columns(), 'trip_count', 'PULocationID', 20)})",
    ], "SELECT best.*, zones.* FROM best LEFT JOIN zones ON PULocationID = LocationID"),
    "order_location_stats": with_ctes(
        [ORDERS, featured("valid_orders"), location_stats("featured")],
        f"SELECT {stats_columns()} FROM stats",
    ),
    "order_hotspot_labels": with_ctes([
        ORDERS,
        featured("valid_orders"),
        location_stats("featured"),
        f"best AS ({ranked('stats', 'PULocationID, trip_count, total_revenue', 'total_revenue', 'PULocationID', 20)})",
    ], """
SELECT rank, PULocationID, coalesce(s_name, 'Loc ' || PULocationID) AS zone_label, trip_count,
       round(total_revenue / 1000000, 4) AS revenue_millions
FROM best LEFT JOIN supplier ON PULocationID = s_suppkey"""),
    "top_by_trips": with_ctes(ON_STATS, ranked("stats", stats_columns(), "trip_count", "PULocationID", 20)),
    "top_by_revenue": with_ctes(
        ON_STATS, ranked("stats", stats_columns(), "total_revenue", "PULocationID", 20)
    ),
    "top_by_profit": with_ctes(ON_STATS, ranked("stats", stats_columns(), "profit_score", "PULocationID", 20)),
    "hourly_pattern": with_ctes(
        [*BASE, FEATURED], pattern("featured", "PULocationID", "count(*)", 5, "pickup_hour")
    ),
    "daily_pattern": with_ctes(
        [*BASE, FEATURED], pattern("featured", "PULocationID", "count(*)", 5, "pickup_dayofweek", WEEKDAY)
    ),
    "temporal_patterns": with_ctes([*BASE, FEATURED], f"""
SELECT PULocationID, 'hour' AS pattern, pickup_hour AS value, trips
FROM ({pattern("featured", "PULocationID", "count(*)", 5, "pickup_hour")})
UNION ALL SELECT PULocationID, 'weekday', pickup_dayofweek, trips
FROM ({pattern("featured", "PULocationID", "count(*)", 5, "pickup_dayofweek")})"""),
    "hotspot_labels": with_ctes([
        *ON_STATS,
        ZONES,
        f"best AS ({ranked('stats', 'PULocationID, trip_count, total_revenue', 'trip_count', 'PULocationID', 10)})",
    ], """
SELECT rank, PULocationID, coalesce(Zone, 'Loc ' || PULocationID) AS zone_label, trip_count,
       round(total_revenue / 1000000, 6) AS revenue_millions
FROM best LEFT JOIN zones ON PULocationID = LocationID"""),
    "revenue_vs_volume": with_ctes(ON_STATS, ranked(
        "stats",
        """PULocationID, round(trip_count / 1000, 6) AS trips_thousands,
    round(total_revenue / 1000000, 6) AS revenue_millions""",
        "trip_count",
        "PULocationID",
        20,
    )),
    "nearest_center": with_ctes(ON_CLUSTERS, """
SELECT trip_id, PULocationID, latitude, longitude, cluster, distance FROM clustered"""),
    "cluster_attach": with_ctes(
        ON_CLUSTERS, "SELECT trip_id, PULocationID, latitude, longitude, cluster FROM clustered"
    ),
    "cluster_counts": with_ctes(
        ON_CLUSTERS, "SELECT cluster, count(*) AS trip_count FROM clustered GROUP BY cluster"
    ),
    "cluster_stats": with_ctes(ON_CLUSTERS, """
SELECT cluster, count(*) AS trip_count, round(avg(latitude), 4) AS center_lat,
       round(avg(longitude), 4) AS center_lon, round(CAST(sum(CAST(fare_amount AS DECIMAL(18,4))) AS DOUBLE) / count(fare_amount), 4) AS avg_fare,
       round(CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE) / count(total_revenue), 4) AS avg_revenue
FROM clustered GROUP BY cluster"""),
    "cluster_metrics": with_ctes(ON_METRICS, f"SELECT {METRIC_COLUMNS} FROM metrics"),
    "peak_hour": with_ctes(ON_CLUSTERS, """
SELECT cluster, pickup_hour AS peak_hour FROM (
    SELECT cluster, pickup_hour, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, pickup_hour) AS r
    FROM clustered GROUP BY cluster, pickup_hour)
WHERE r = 1"""),
    "location_peak_hour": with_ctes([*BASE, FEATURED], """
SELECT PULocationID, pickup_hour AS peak_hour FROM (
    SELECT PULocationID, pickup_hour,
           row_number() OVER (PARTITION BY PULocationID ORDER BY count(*) DESC, pickup_hour) AS r
    FROM featured GROUP BY PULocationID, pickup_hour)
WHERE r = 1"""),
    "cluster_hourly_pattern": with_ctes(
        ON_CLUSTERS, pattern("clustered", "cluster", "sum(total_revenue)", 3, "pickup_hour")
    ),
    "cluster_daily_pattern": with_ctes(
        ON_CLUSTERS, pattern("clustered", "cluster", "sum(total_revenue)", 3, "pickup_dayofweek", WEEKDAY)
    ),
    "rank_revenue": with_ctes(ON_METRICS, ranked("metrics", METRIC_COLUMNS, "total_revenue", "cluster", 10)),
    "rank_count": with_ctes(ON_METRICS, ranked("metrics", METRIC_COLUMNS, "trip_count", "cluster", 10)),
    "rank_avg_fare": with_ctes(ON_METRICS, ranked("metrics", METRIC_COLUMNS, "avg_fare", "cluster", 10)),
    "rank_combined": with_ctes([
        *ON_METRICS,
        """scored AS (
    SELECT *, (trip_count / (SELECT max(trip_count) FROM metrics))
              * (avg_fare / (SELECT max(avg_fare) FROM metrics)) AS profitability_score
    FROM metrics
)""",
    ], ranked(
        "scored",
        METRIC_COLUMNS + ", round(profitability_score, 4) AS profitability_score",
        "profitability_score",
        "cluster",
        10,
    )),
    "hotspot_report": with_ctes([
        *ON_METRICS,
        f"best AS ({ranked('metrics', METRIC_COLUMNS, 'total_revenue', 'cluster', 10)})",
        """hours AS (SELECT cluster, pickup_hour AS h, count(*) AS n FROM clustered GROUP BY cluster, pickup_hour),
days AS (SELECT cluster, pickup_dayofweek AS d, count(*) AS n FROM clustered GROUP BY cluster, pickup_dayofweek),
hourly AS (
    SELECT cluster, string_agg(h || ':' || n, ',' ORDER BY h) AS hourly,
           CAST(first(h ORDER BY n DESC, h) AS INTEGER) AS peak_hour
    FROM hours GROUP BY cluster
),
daily AS (SELECT cluster, string_agg(d || ':' || n, ',' ORDER BY d) AS daily FROM days GROUP BY cluster)""",
    ], """
SELECT best.*, hourly, peak_hour, daily, latitude, longitude
FROM best JOIN hourly USING (cluster) JOIN daily USING (cluster) LEFT JOIN centers USING (cluster)"""),
    "cluster_distribution": with_ctes(ON_CLUSTERS, """
SELECT cluster, count(*) AS trip_count, count(*) / 1000000 AS trips_millions FROM clustered GROUP BY cluster"""),
    "fare_tiers": with_ctes(ON_STATS, """
SELECT PULocationID, trip_count, round(avg_fare, 4) AS avg_fare,
       CASE WHEN avg_fare > 25 THEN 'airport' WHEN avg_fare > 15 THEN 'high' ELSE 'regular' END AS tier
FROM stats"""),
    "map_points": with_ctes([
        *ON_METRICS,
        "best AS (SELECT * FROM metrics ORDER BY trip_count DESC, cluster LIMIT 10)",
    ], """
SELECT cluster, latitude, longitude, trip_count, round(total_revenue, 4) AS total_revenue,
       round(avg_fare, 4) AS avg_fare,
       round(least(CAST(20 AS DOUBLE) + trip_count / 1000, CAST(50 AS DOUBLE)), 4) AS radius,
       CASE WHEN total_revenue > 1000000 THEN 'red' WHEN total_revenue > 500000 THEN 'orange'
            ELSE 'blue' END AS color
FROM best JOIN centers USING (cluster)"""),
    "bar_feed": with_ctes(ON_METRICS, ranked(
        "metrics",
        "'Cluster ' || cluster AS label, round(total_revenue, 4) AS value",
        "total_revenue",
        "cluster",
        10,
    )),
    "distinct_points": with_ctes(ON_CLUSTERS, """
SELECT latitude, longitude, CAST(count(*) AS DOUBLE) AS point_rows FROM clustered
GROUP BY latitude, longitude"""),
    "wssse_pinned": with_ctes(ON_CLUSTERS, """
SELECT count(*) AS n_rows, round(sum(distance), 6) AS wssse FROM clustered"""),
    "silhouette_pinned": with_ctes([*ON_CLUSTERS, SILHOUETTE], """
SELECT n_rows, round(s, 6) AS silhouette,
       CASE WHEN s > 0.5 THEN 'excellent' WHEN s > 0.25 THEN 'good' WHEN s > 0 THEN 'weak' ELSE 'poor' END AS band
FROM score"""),
    "silhouette_held_out": with_ctes([*ON_CLUSTERS, HELD_OUT], """
SELECT n_rows, round(s, 6) AS silhouette,
       CASE WHEN s > 0.5 THEN 'excellent' WHEN s > 0.25 THEN 'good' WHEN s > 0 THEN 'weak' ELSE 'poor' END AS band
FROM score"""),
    "kmeans_all_points": with_ctes(ON_CLUSTERS, """
SELECT DISTINCT round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, CAST(0 AS DOUBLE) AS wssse
FROM clustered"""),
    "hash_split": f"""
SELECT event_id AS trip_id, CASE WHEN {BUCKET} >= 800000 THEN 'test' ELSE 'train' END AS part FROM events""",
    "hash_sample": with_ctes([TRIPS], f"SELECT trips.* FROM trips JOIN events ON event_id = trip_id WHERE {BUCKET} < 100000"),
    "sample_10000": with_ctes([TRIPS], "SELECT * FROM trips ORDER BY md5('42|' || trip_id), trip_id LIMIT 10000"),
    "scan_drifted": with_ctes([TRIPS], """
SELECT * EXCLUDE (tpep_dropoff_datetime, tip_amount), CASE WHEN trip_id % 3 <> 1 THEN tip_amount END AS tip_amount,
       CASE trip_id % 3 WHEN 1 THEN trip_id % 5 WHEN 2 THEN trip_id % 7 / 4 END AS airport_fee
FROM trips"""),
    "audit_rows": """
SELECT 'events.parquet' AS "table", count(*) AS n_rows, count(*) > 0 AS is_present FROM events
UNION ALL SELECT 'orders.parquet', count(*), count(*) > 0 FROM orders
UNION ALL SELECT 'lineitem.parquet', count(*), count(*) > 0 FROM lineitem
UNION ALL SELECT 'taxi.parquet', 0, false""",
    "amount_extremes": """
SELECT l_returnflag, l_linestatus, count(amount) AS amounts,
       CASE WHEN bool_or(isnan(kind)) THEN 'NaN'::DOUBLE ELSE round(sum(amount)::DOUBLE / 1e12, 6) END AS trillions,
       CASE WHEN bool_or(isnan(kind)) THEN 'NaN'::DOUBLE ELSE round(sum(amount)::DOUBLE / count(amount) / 1e6, 6) END AS mean_millions
FROM (
    SELECT l_returnflag, l_linestatus,
           CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'NaN'::DOUBLE ELSE 0 END AS kind,
           CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 0 WHEN l_linenumber = 6 THEN price * 10000000000
               WHEN l_linenumber = 5 THEN price * 0.00001 WHEN l_linenumber < 5 THEN l_extendedprice::DECIMAL(28, 10)
           END::DECIMAL(28, 10) AS amount
    FROM (SELECT *, round(l_extendedprice)::DECIMAL(20, 0) AS price FROM lineitem)
) GROUP BY 1, 2""",
    "stream_parse": with_ctes([TRIPS], TRIP_TEXT),
    "stream_scored": with_ctes([TRIPS, CENTROIDS, CENTER_TABLE, DISTANCES], """
SELECT trip_id, PULocationID, latitude, longitude, cluster
FROM trips JOIN centroids p ON PULocationID = p.LocationID JOIN zone_clusters z ON z.LocationID = p.LocationID"""),
    "stream_cluster_counts": with_ctes([TRIPS, CENTROIDS, CENTER_TABLE, DISTANCES], """
SELECT cluster, count(*) AS trip_count
FROM trips JOIN zone_clusters ON PULocationID = LocationID GROUP BY cluster"""),
    "stream_batches": """
SELECT CAST(5 AS BIGINT) AS n_batches, CAST(4 AS BIGINT) AS last_batch, count(*) AS n_rows, true AS is_even FROM events""",
    "stream_model_counts": with_ctes([TRIPS, CENTROIDS, CENTER_TABLE, DISTANCES], """
SELECT round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, count(*) AS trip_count
FROM trips JOIN zone_clusters ON PULocationID = LocationID JOIN centers USING (cluster) GROUP BY ALL"""),
    "stream_top_locations": with_ctes([TRIPS], """
SELECT PULocationID, count(*) AS trip_count FROM trips GROUP BY PULocationID
ORDER BY trip_count DESC, PULocationID LIMIT 10"""),
}
ORACLES["dedup_rare"] = ORACLES["dedup_all"]
ORACLES["zone_enrich_large"] = ORACLES["zone_enrich"]
ORACLES["location_stats_from_cells"] = ORACLES["location_stats"]
ORACLES["cluster_stats_from_cells"] = ORACLES["cluster_stats"]
ORACLES["cluster_metrics_from_cells"] = ORACLES["cluster_metrics"]
ORACLES["stream_live_counts"] = with_ctes([TRIPS], """
SELECT PULocationID, count(*) AS trip_count FROM (
    SELECT PULocationID FROM trips UNION ALL SELECT NULL FROM trips WHERE tip_amount > 0
) GROUP BY PULocationID ORDER BY trip_count DESC, PULocationID NULLS FIRST LIMIT 10""")
