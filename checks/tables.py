"""Domain tables derived from the shared Parquet tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.times import floor_hour, hour_number
from zonecast.operators.calendars import serving_calendar
from zonecast.operators.lags import lag_features
from zonecast.operators.panel import panel_full
from zonecast.operators.scoring import score_linear
from zonecast.operators.spatial import zone_adjacency
from zonecast.operators.weather import panel_weather
from zonecast.plans.features import clean_trips
from zonecast.plans.scoring import HISTORY
from zonecast.schemas import FEEDS, HOURLY_WEATHER, TARGETS, WEATHER_FIELDS, ZONE
from zonecast.session import stage

AS_OF = datetime(2024, 1, 20, 12, 10)
SERVED_HOUR = datetime(2024, 1, 20, 12)
COEFS = {
    t: {f"{t}_lag_1h": 40.0, f"{t}_lag_24h": 10.5, "intercept": -0.5} for t in TARGETS
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed_of(events: DataFrame, feed: str) -> DataFrame:
    """One trip feed from (batch or streaming) events."""
    kinds = {"yellow": ["view", "signup"], "green": ["click"], "hvfhv": ["purchase", "error"]}[feed]
    minutes = (F.col("event_id") % 50 - 1).cast("int")
    columns = {
        "pickup": F.col("ts"),
        "dropoff": F.col("ts") + F.make_dt_interval(mins=minutes),
        "pulocationid": F.col("user_id").cast("int"),
        "dolocationid": (F.col("event_id") % 25).cast("int"),
        "miles": F.col("value") / 10,
        "trip_time": (minutes * 60).cast("bigint"),
    }
    names = FEEDS[feed].schema.names
    return events.where(F.col("event_type").isin(kinds)).select(
        *[column.alias(name) for column, name in zip(columns.values(), names)]
    )


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = table(spark, sf_dir, "events")
    return {feed: feed_of(events, feed) for feed in FEEDS}


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(feeds(spark, sf_dir))


def _hour_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = table(spark, sf_dir, "events").groupBy(floor_hour(F.col("ts")).alias("hr")).agg(
        F.sum("event_id").alias("s")
    )
    return hours.withColumn("h", hour_number(F.col("hr"))).where("h % 97 <> 50")


def _readings() -> dict:
    s, h = F.col("s"), F.col("h")
    return {
        "humidity": (s * 13 % 1000) / 10,
        "precip": F.when(h % 5 != 0, (s % 7) / 10),
        "windspeed": (s * 3 % 250) / 10,
        "feelslike": (s * 7 % 900) / 10,
        "visibility": (s % 11).cast("double"),
    }


def hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    clock = F.when(F.col("h") % 113 == 7, "bad").otherwise(F.date_format("hr", "HH:mm:ss"))
    missing = {n: F.lit(None).cast("double") for n in WEATHER_FIELDS if n not in _readings()}
    return _hour_sums(spark, sf_dir).withColumns(
        {"day": F.date_format("hr", "yyyy-MM-dd"), "datetime": clock, **_readings(), **missing}
    ).select(*HOURLY_WEATHER.names)


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per month with at most 31 days of at most 24 hours each."""
    hour = F.struct("datetime", *_readings())
    days = hourly_weather(spark, sf_dir).groupBy("day").agg(F.collect_list(hour).alias("hours"))
    day = F.struct(F.col("day").alias("datetime"), "hours")
    return days.groupBy(F.substring("day", 1, 7).alias("month")).agg(
        F.to_json(F.struct(F.collect_list(day).alias("days"))).alias("document")
    )


def current_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per observed hour; some have no current conditions."""
    events = table(spark, sf_dir, "events")
    hours = events.groupBy(floor_hour(F.col("ts")).alias("hr")).agg(F.sum("event_id").alias("s"))
    hours = hours.withColumn("h", hour_number(F.col("hr"))).withColumns(_readings())
    clock = F.concat(F.date_format("hr", "HH"), F.lit(":05:00")).alias("datetime")
    now = F.to_json(F.struct(F.struct(clock, *_readings()).alias("currentConditions")))
    return hours.select(
        (F.col("hr") + F.make_dt_interval(mins=F.lit(5))).alias("observed_at"),
        F.when(F.col("h") % 97 == 50, F.lit("{}")).otherwise(now).alias("document"),
    )


def _with_region(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return df.join(nation, F.col("n_nationkey") == F.col("c_nationkey")).join(
        region, F.col("r_regionkey") == F.col("n_regionkey")
    )


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return _with_region(table(spark, sf_dir, "customer"), spark, sf_dir).select(
        key.cast("int").alias("locationid"),
        F.when(key % 23 == 22, "").otherwise(F.concat(F.lit("Zone "), key)).alias("zone"),
        F.when(key % 29 == 22, "NOWHERE").otherwise(F.col("r_name")).alias("borough"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup(spark, sf_dir).withColumnRenamed("locationid", ZONE)


def road_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = _with_region(
        orders.join(customer, F.col("c_custkey") == F.col("o_custkey")), spark, sf_dir
    )
    name = F.concat(F.lit("ramp zone "), F.col("o_custkey"), F.lit(" nb"))
    link = F.when(F.col("o_custkey") % 3 == 0, "bridge approach")
    link = link.when(F.col("o_orderkey") % 2 == 0, F.upper(name)).otherwise(name)
    unreadable = (F.col("o_orderkey") % 17 == 0) | (F.col("o_custkey") % 41 == 5)
    mph = F.floor(F.col("o_totalprice") / 10000).cast("string")
    return joined.select(
        link.alias("link_name"),
        F.col("r_name").alias("borough"),
        F.when(unreadable, "n/a").otherwise(mph).alias("speed"),
        F.floor(F.col("o_orderkey") / 50).alias("data_as_of"),
    )


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles on a grid: neighbours, shifted ones, overlaps, copies and islands, in both turns."""
    key = F.col("c_custkey")
    island, copied, shifted = key % 50 == 0, key % 17 == 0, key % 13 == 0
    row = lambda k: F.floor(k / 40).cast("double")
    x = (
        F.when(island, F.lit(1000.0) + key * 3.0)
        .when(copied, ((key - 1) % 40).cast("double"))
        .when(shifted, (key % 40).cast("double") + 0.5)
        .otherwise((key % 40).cast("double"))
    )
    y = (
        F.when(island, row(key)).when(copied, row(key - 1)).when(shifted, row(key) + 0.5).otherwise(row(key))
    )
    boxes = table(spark, sf_dir, "customer").select(
        key.cast("int").alias(ZONE), x.alias("x"), y.alias("y"),
        F.when(key % 11 == 0, 2.0).otherwise(1.0).alias("w"),
        F.when(key % 7 == 0, 0.5).otherwise(1.0).alias("h"),
    )
    corner = lambda dx, dy: F.struct(
        (F.col("x") + dx * F.col("w")).alias("x"), (F.col("y") + dy * F.col("h")).alias("y")
    )
    ring = F.array(*[corner(dx, dy) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    return boxes.select(ZONE, F.when(F.col(ZONE) % 2 == 1, F.reverse(ring)).otherwise(ring).alias("ring"))


def zones_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones of two far parts: squares on a grid, some too wide, some with a hole, some in the hole or the square before."""
    key = F.col("c_custkey")
    placed = F.when((key % 5 == 1) | (key % 13 == 4), key - 1).otherwise(key)
    inset = F.when(key % 5 == 1, F.when(key % 11 == 3, 1.25).otherwise(1.0)).when(key % 13 == 4, 0.5).otherwise(0.0)
    side = F.when(key % 5 == 1, F.when(key % 11 == 3, 0.5).otherwise(1.0)).when(key % 13 == 4, 0.25).otherwise(3.0)
    boxes = table(spark, sf_dir, "customer").select(
        (key - 800 * (F.floor(key / 800) % 2)).cast("int").alias(ZONE), ((key % 5 == 0) & (key % 13 != 4)).alias("frame"),
        (placed % 40 * 3 + inset).alias("x"), (F.floor(placed / 40) * 3 + inset).alias("y"),
        F.when(key % 35 == 7, 3.5).otherwise(side).alias("w"), side.alias("h"),
    )
    ring = lambda x, y, w, h: F.array(*[F.struct((x + dx * w).alias("x"), (y + dy * h).alias("y")) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1))])
    outer = boxes.select(ZONE, F.lit(False).alias("hole"), ring(*map(F.col, "xywh")).alias("ring"))
    inner = ring(F.col("x") + 1, F.col("y") + 1, F.lit(1.0), F.lit(1.0)).alias("ring")
    return outer.unionByName(boxes.where("frame").select(ZONE, F.lit(True).alias("hole"), inner))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adjacency as the jobs find it: a written table."""
    return stage(zone_adjacency(polygons(spark, sf_dir)), "edges")


def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates with an hour from the order key."""
    hour = (F.col("o_orderkey") % 24).cast("int")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderdate") + F.make_dt_interval(hours=hour)).alias("bin")
    )


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction log: the linear forecast of every panel row."""
    panel = lag_features(panel_full(trips(spark, sf_dir)), TARGETS)
    panel = serving_calendar(panel_weather(panel, hourly_weather(spark, sf_dir)))
    return score_linear(panel, COEFS).select(*HISTORY)


def history_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction log that holds the actual targets."""
    panel = panel_full(trips(spark, sf_dir))
    panel = serving_calendar(panel_weather(panel, hourly_weather(spark, sf_dir)))
    return panel.withColumns({t: F.col(t).cast("double") for t in TARGETS}).select(*HISTORY)


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    scale = float(10**digits)
    return df.withColumns({c: F.rint(F.col(c) * scale) / scale for c in cols})
