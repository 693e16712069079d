"""Feeds, trips and the panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables
from checks.expressions import CITY, NEIGHBOR, TARGETS, lags, rounded
from checks.registry import query
from zonecast.functions.times import naive
from zonecast.operators import panel, trips
from zonecast.operators.lags import city_demand, lag_features
from zonecast.operators.profiling import narrow_types, profile_columns
from zonecast.operators.spatial import load_or_build_adjacency, neighbor_demand, neighbor_lists, zone_adjacency
from zonecast.plans.features import feature_panel
from zonecast.schemas import BIN, CITY_DEMAND, NEIGHBOR_DEMAND, ZONE
from zonecast.session import new_stage_path, stage
from zonecast.sources.feeds import extract_links, scan_feed, select_feed_files
from zonecast.sources.store import backfill_months

MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["'']([^"'']*)["'']"""


@query("scan_feed", "SELECT * FROM hvfhv_feed")
def scan(spark: SparkSession, sf: str) -> DataFrame:
    path = new_stage_path(spark, "feed")
    tables.feeds(spark, sf)["hvfhv"].withColumn("unused", F.lit("x")).write.parquet(path)
    return scan_feed(spark, "hvfhv", path)


@query(
    "extract_links",
    f"""SELECT page_id, CAST(unnest(generate_series(0, len(links) - 1)) AS INTEGER) AS position,
        replace(unnest(links), '&amp;', '&') AS href
        FROM (SELECT page_id, regexp_extract_all(regexp_replace(html, '{MARKUP}', '', 'g'), '{ANCHOR}', 1) AS links
              FROM pages) WHERE len(links) > 0""",
)
def links(spark: SparkSession, sf: str) -> DataFrame:
    return extract_links(tables.table(spark, sf, "pages"))


@query(
    "select_feed_files",
    """SELECT page_id, arg_max(url, position) AS url FROM (SELECT o_custkey AS page_id, o_orderkey AS position,
        CASE o_orderkey % 3 WHEN 0 THEN 'https://files.example.org' || '/trip-data/yellow_tripdata_' || strftime(o_orderdate, '%Y-%m') || '.parquet'
        WHEN 1 THEN 'https://cdn.example.org/YELLOW_TRIPDATA_' || strftime(o_orderdate, '%Y-%m') || '.PARQUET'
        ELSE 'https://files.example.org' || '/trip-data/green_tripdata_' || strftime(o_orderdate, '%Y-%m') || '.parquet' END AS url
        FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1996-03' AND o_orderkey % 3 <> 2) GROUP BY page_id""",
)
def feed_files(spark: SparkSession, sf: str) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyy-MM")
    key = F.col("o_orderkey") % 3
    href = (
        F.when(key == 0, F.concat(F.lit("/trip-data/yellow_tripdata_"), month, F.lit(".parquet")))
        .when(key == 1, F.concat(F.lit("https://cdn.example.org/YELLOW_TRIPDATA_"), month, F.lit(".PARQUET")))
        .otherwise(F.concat(F.lit("/trip-data/green_tripdata_"), month, F.lit(".parquet")))
    )
    found = tables.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("page_id"), F.col("o_orderkey").alias("position"), href.alias("href")
    )
    return select_feed_files(found, "yellow", "1996-03", host="https://files.example.org")


@query(
    "backfill_months",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS trips,
        CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders
        WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1998-06-01' GROUP BY ALL""",
)
def backfill(spark: SparkSession, sf: str) -> DataFrame:
    dated = tables.table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("pickup_datetime"), "o_orderkey"
    )
    stored = backfill_months(dated, "1996-03-01", "1998-05-20", new_stage_path(spark, "months"))
    return stored.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("o_orderkey").alias("key_sum")
    )


@query("normalize_feeds", f"SELECT * EXCLUDE (trip_duration_hr), {rounded('trip_duration_hr', 'trip_duration_hr')} FROM norm_trips")
def normalized(spark: SparkSession, sf: str) -> DataFrame:
    feeds = tables.feeds(spark, sf)
    stacked = trips.union_feeds(*[trips.normalize_feed(df, f) for f, df in feeds.items()])
    return tables.rounded(stacked, "trip_duration_hr")


@query("union_feeds", "SELECT service_type, count(*) AS trips, min(pickup_datetime) AS first_pickup FROM norm_trips GROUP BY 1")
def union(spark: SparkSession, sf: str) -> DataFrame:
    feeds = tables.feeds(spark, sf)
    stacked = trips.union_feeds(*[trips.normalize_feed(df, f) for f, df in feeds.items()])
    return stacked.groupBy("service_type").agg(
        F.count(F.lit(1)).alias("trips"), F.min("pickup_datetime").alias("first_pickup")
    )


@query(
    "window_filter",
    """SELECT pickup_datetime, pulocationid, trip_miles FROM norm_trips
        WHERE pickup_datetime >= TIMESTAMP '2024-01-05' AND pickup_datetime < TIMESTAMP '2024-01-21'""",
)
def window(spark: SparkSession, sf: str) -> DataFrame:
    feeds = tables.feeds(spark, sf)
    stacked = trips.union_feeds(*[trips.normalize_feed(df, f) for f, df in feeds.items()])
    return trips.window_filter(stacked, "2024-01-05", "2024-01-20").select(
        "pickup_datetime", "pulocationid", "trip_miles"
    )


@query(
    "trip_duration",
    f"SELECT service_type, pickup_datetime, {rounded('trip_duration_hr', 'trip_duration_hr')} FROM norm_trips",
)
def duration(spark: SparkSession, sf: str) -> DataFrame:
    return normalized(spark, sf).select("service_type", "pickup_datetime", "trip_duration_hr")


@query(
    "valid_trips",
    f"SELECT pickup_datetime, pulocationid, service_type, trip_miles, {rounded('mph', 'mph')} FROM good_trips",
)
def valid(spark: SparkSession, sf: str) -> DataFrame:
    return tables.rounded(tables.trips(spark, sf), "mph").select(
        "pickup_datetime", "pulocationid", "service_type", "trip_miles", "mph"
    )


@query("hour_bin", "SELECT event_id, ts, date_trunc('hour', ts) AS bin FROM events")
def binned(spark: SparkSession, sf: str) -> DataFrame:
    return trips.hour_bin(tables.table(spark, sf, "events").select("event_id", "ts"), "ts")


_PROFILE = " UNION ALL ".join(
    [
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, CAST(min({c}) AS DOUBLE) AS min_value,
        CAST(max({c}) AS DOUBLE) AS max_value, CAST(-1 AS BIGINT) AS distinct_count,
        CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint' WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint'
        WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END AS narrow_type FROM orders"""
        for c in ("o_orderkey", "o_custkey")
    ]
    + [
        """SELECT 'o_totalprice', count(*), min(o_totalprice), max(o_totalprice), CAST(-1 AS BIGINT),
        CASE WHEN max(abs(o_totalprice - CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE))) <= 5e-4 THEN 'float' ELSE 'double' END FROM orders"""
    ]
    + [
        f"""SELECT '{c}', count(*), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), count(DISTINCT {c}),
        CASE WHEN count(DISTINCT {c}) / count(*) < 0.5 THEN 'category' ELSE 'string' END FROM orders"""
        for c in ("o_orderstatus", "o_orderpriority")
    ]
)


@query("profile_columns", _PROFILE)
def profile(spark: SparkSession, sf: str) -> DataFrame:
    found = profile_columns(tables.table(spark, sf, "orders"))
    return found.fillna(-1, ["distinct_count"])


@query("trip_counts", "SELECT bin, zone_id, service_type, count(*) AS trip_count FROM good_trips GROUP BY ALL")
def counts(spark: SparkSession, sf: str) -> DataFrame:
    return panel.trip_counts(tables.trips(spark, sf))


@query("zone_hour_grid", "SELECT bin, zone_id FROM observed_grid")
def grid(spark: SparkSession, sf: str) -> DataFrame:
    return panel.zone_hour_grid(tables.trips(spark, sf))


@query("continuous_grid", "SELECT bin, zone_id FROM span_grid")
def span_grid(spark: SparkSession, sf: str) -> DataFrame:
    return panel.zone_hour_grid(tables.trips(spark, sf), continuous=True)


@query("hourly_targets", f"SELECT bin, zone_id, {', '.join(TARGETS)} FROM panel")
def targets(spark: SparkSession, sf: str) -> DataFrame:
    return panel.hourly_targets(tables.trips(spark, sf))


@query(
    "city_speed",
    f"SELECT bin, {rounded('mean_mph', 'city_avg_speed')}, {rounded('1 / mean_mph', 'city_congestion_index')} FROM city_mph",
)
def city(spark: SparkSession, sf: str) -> DataFrame:
    return tables.rounded(
        panel.city_speed(tables.trips(spark, sf)), "city_avg_speed", "city_congestion_index"
    )


@query(
    "zone_speed",
    f"""SELECT bin, zone_id, {rounded('v', 'zone_avg_speed')}, {rounded('1 / v', 'zone_congestion_index')}
        FROM (SELECT g.bin, g.zone_id, coalesce(nullif(coalesce(c.zone_mph, m.mean_mph), 0),
              (SELECT avg(mean_mph) FROM city_mph)) AS v
              FROM span_grid g LEFT JOIN trip_cell c USING (bin, zone_id) LEFT JOIN city_mph m USING (bin))""",
)
def zone(spark: SparkSession, sf: str) -> DataFrame:
    return tables.rounded(
        panel.zone_speed(tables.trips(spark, sf)), "zone_avg_speed", "zone_congestion_index"
    )


@query("panel_full", "SELECT * FROM panel")
def full(spark: SparkSession, sf: str) -> DataFrame:
    return panel.panel_full(tables.trips(spark, sf))


@query("adjacency_cache", "SELECT zone_id, neighbor_id FROM adjacency")
def cached(spark: SparkSession, sf: str) -> DataFrame:
    """The adjacency as the second run finds it; the first builds and writes it."""
    path = new_stage_path(spark, "edges")
    load_or_build_adjacency(tables.polygons(spark, sf), path)
    return load_or_build_adjacency(tables.polygons(spark, sf).where("false"), path)


@query(
    "narrow_types",
    """SELECT o_orderkey, CAST(o_orderkey % 100 AS TINYINT) AS part, o_totalprice,
        CAST((o_custkey % 64) / 4.0 AS FLOAT) AS quarter FROM orders""",
)
def narrowed(spark: SparkSession, sf: str) -> DataFrame:
    """One column that fits a small type, one that may be a float and one that must stay a double."""
    orders = tables.table(spark, sf, "orders")
    numbers = narrow_types(orders.select(
        F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 100).alias("part"), "o_totalprice",
        ((F.col("o_custkey") % 64) / F.lit(4.0)).alias("quarter"),
    ))
    return numbers.withColumn("o_orderkey", F.col("key").cast(orders.schema["o_orderkey"].dataType)).drop("key")


@query("zone_adjacency", "SELECT zone_id, neighbor_id FROM adjacency")
def adjacency(spark: SparkSession, sf: str) -> DataFrame:
    return zone_adjacency(tables.polygons(spark, sf))


@query(
    "zone_adjacency_parts",
    """SELECT a.zone_id, b.zone_id AS neighbor_id FROM part_pieces a JOIN part_pieces b ON a.zone_id <> b.zone_id
        AND a.x <= b.x2 AND b.x <= a.x2 AND a.y <= b.y2 AND b.y <= a.y2 GROUP BY ALL
        HAVING NOT bool_or(a.x < b.x2 AND b.x < a.x2 AND a.y < b.y2 AND b.y < a.y2)""",
)
def adjacency_of_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Zones of several parts, with holes, with parts within other zones and in their holes."""
    return zone_adjacency(tables.zones_of_parts(spark, sf))


@query(
    "neighbor_lists",
    """SELECT b.zone_id, coalesce(string_agg(CAST(a.neighbor_id AS VARCHAR), ',' ORDER BY a.neighbor_id), '-1') AS neighbors
        FROM boxes b LEFT JOIN adjacency a USING (zone_id) GROUP BY b.zone_id""",
)
def lists(spark: SparkSession, sf: str) -> DataFrame:
    shapes = tables.polygons(spark, sf)
    found = neighbor_lists(zone_adjacency(shapes), shapes)
    return found.select(ZONE, F.array_join("neighbors", ",").alias("neighbors"))


@query(
    "neighbor_demand",
    f"SELECT bin, zone_id, {', '.join(TARGETS)}, {', '.join(NEIGHBOR)} FROM neighbor_panel",
)
def neighbors(spark: SparkSession, sf: str) -> DataFrame:
    dense = stage(panel.hourly_targets(tables.trips(spark, sf)), "targets")
    return neighbor_demand(dense, tables.edges(spark, sf))


@query("city_demand", f"SELECT bin, zone_id, {', '.join(TARGETS)}, {', '.join(CITY)} FROM panel JOIN city_sums USING (bin)")
def demand(spark: SparkSession, sf: str) -> DataFrame:
    return city_demand(panel.hourly_targets(tables.trips(spark, sf)))


def _lag_source(spark: SparkSession, sf: str) -> DataFrame:
    dense = stage(panel.hourly_targets(tables.trips(spark, sf)), "targets")
    return neighbor_demand(city_demand(dense), tables.edges(spark, sf))


_LAGGED = f"""SELECT bin, zone_id, {lags(TARGETS + CITY + NEIGHBOR, (1, 24))}
    FROM neighbor_panel JOIN city_sums USING (bin)"""


@query("lag_features", _LAGGED)
def lagged(spark: SparkSession, sf: str) -> DataFrame:
    return lag_features(_lag_source(spark, sf)).drop(*TARGETS, *CITY_DEMAND, *NEIGHBOR_DEMAND)


@query("lag_features_blocks", f"SELECT bin, zone_id, {lags(TARGETS, (1, 24))} FROM panel")
def lagged_blocks(spark: SparkSession, sf: str) -> DataFrame:
    dense = panel.hourly_targets(tables.trips(spark, sf))
    return lag_features(dense, TARGETS, block_rows=100).drop(*TARGETS)


@query(
    "lag_features_time",
    "SELECT p.bin, p.zone_id, "
    + ", ".join(
        f"coalesce(max({t}) OVER (PARTITION BY zone_id ORDER BY bin RANGE BETWEEN INTERVAL {k} HOUR PRECEDING AND INTERVAL {k} HOUR PRECEDING), 0) AS {t}_lag_{k}h"
        for t in TARGETS for k in (1, 24)
    )
    + " FROM panel p",
)
def lagged_time(spark: SparkSession, sf: str) -> DataFrame:
    dense = panel.hourly_targets(tables.trips(spark, sf))
    return lag_features(dense, TARGETS, mode="time").drop(*TARGETS)


@query("feature_panel_in_parts", "SELECT * FROM full_panel")
def features_in_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The panel built half by half; rows of the first half's last week feed the second half's lags."""
    trips, weather, edges = tables.trips(spark, sf), tables.hourly_weather(spark, sf), tables.edges(spark, sf)
    cut = naive("2024-01-16")
    first = stage(feature_panel(trips.where(F.col(BIN) < cut), weather, edges), "first")
    known = first.where(F.col(BIN) >= naive("2024-01-09"))
    return first.unionByName(feature_panel(trips.where(F.col(BIN) >= cut), weather, edges, carry_in=known))


@query("feature_panel", "SELECT * FROM full_panel")
def features(spark: SparkSession, sf: str) -> DataFrame:
    return feature_panel(
        tables.trips(spark, sf),
        tables.hourly_weather(spark, sf),
        tables.edges(spark, sf),
    )
