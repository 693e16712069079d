"""Calendar and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables
from checks.expressions import BIN_CALENDAR
from checks.registry import query
from zonecast.operators import calendars
from zonecast.operators.panel import panel_full
from zonecast.operators.weather import current_weather, dedup_weather, flatten_weather, panel_weather, weather_bin

DAYS = "(SELECT o_orderkey, o_orderdate + to_hours(o_orderkey % 24) AS bin FROM orders)"


def _register(name: str, part: str, step) -> None:
    sql = f"SELECT o_orderkey, bin, {BIN_CALENDAR[part]} FROM {DAYS}"
    query(name, sql)(lambda spark, sf: step(tables.calendar_days(spark, sf)))


_register("calendar_parts", "parts", calendars.calendar_parts)
_register("calendar_flags", "flags", calendars.calendar_flags)
_register("season", "season", calendars.season)
_register("holidays", "holiday", calendars.holidays)
_register("special_events", "special", calendars.special_events)
_register("payday", "payday", calendars.payday)
_register("serving_calendar", "serving", calendars.serving_calendar)


@query(
    "payday_strict",
    f"""SELECT o_orderkey, bin, CAST(CAST(bin AS DATE) = last_day(bin)
        OR (day(bin) BETWEEN 15 AND 17 AND isodow(bin) <= 5) AS INTEGER) AS is_payday FROM {DAYS}""",
)
def strict(spark: SparkSession, sf: str) -> DataFrame:
    return calendars.payday(tables.calendar_days(spark, sf), strict=True)


@query(
    "target_hour",
    """SELECT event_id, ts, date_trunc('hour', ts) + CASE WHEN minute(ts) < 35 THEN INTERVAL 0 HOUR ELSE INTERVAL 1 HOUR END AS target_hour
        FROM events""",
)
def target(spark: SparkSession, sf: str) -> DataFrame:
    return calendars.target_hour(tables.table(spark, sf, "events").select("event_id", "ts"))


@query(
    "month_windows",
    """SELECT o_orderkey, CAST(as_of AS VARCHAR) AS as_of, strftime(m - INTERVAL 13 MONTH, '%Y-%m-%d') AS ingest_start,
        strftime(last_day(m - INTERVAL 13 MONTH), '%Y-%m-%d') AS ingest_end, strftime(m - INTERVAL 13 MONTH, '%Y-%m-%d') AS train_start,
        strftime(m - INTERVAL 1 MONTH, '%Y-%m-%d') AS train_end, CAST(day(last_day(as_of)) AS INTEGER) AS days_in_month
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS as_of, date_trunc('month', o_orderdate) AS m FROM orders)""",
)
def windows(spark: SparkSession, sf: str) -> DataFrame:
    days = tables.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("as_of")
    )
    found = calendars.month_windows(days)
    dates = [name for name, kind in found.dtypes if kind == "date"]
    return found.withColumns({name: F.col(name).cast("string") for name in dates})


@query("flatten_weather", "SELECT * FROM hourly_weather")
def flattened(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_weather(tables.weather_documents(spark, sf))


@query("current_weather", "SELECT * FROM current_docs")
def current(spark: SparkSession, sf: str) -> DataFrame:
    return current_weather(tables.current_documents(spark, sf))


@query("weather_bin", "SELECT * FROM binned_weather")
def weather_hours(spark: SparkSession, sf: str) -> DataFrame:
    return weather_bin(tables.hourly_weather(spark, sf))


@query("dedup_weather", "SELECT * FROM hourly_weather WHERE datetime <> 'bad'")
def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    hours = tables.hourly_weather(spark, sf).where("datetime <> 'bad'")
    lower = hours.withColumn("humidity", F.col("humidity") - 1)
    return dedup_weather(lower.unionByName(hours))


@query("panel_weather", "SELECT * FROM panel LEFT JOIN binned_weather USING (bin)")
def weathered(spark: SparkSession, sf: str) -> DataFrame:
    return panel_weather(panel_full(tables.trips(spark, sf)), tables.hourly_weather(spark, sf))
