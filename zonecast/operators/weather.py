"""Weather documents to hourly rows, and their join to the panel."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.times import floor_hour, plus_hours
from zonecast.operators.keyed import latest_per_key
from zonecast.schemas import BIN, CURRENT_DOCUMENT, HOURLY_WEATHER, WEATHER_DOCUMENT
from zonecast.session import small


def flatten_weather(raw: DataFrame, document: str = "document") -> DataFrame:
    """One row per hour of ``days[].hours[]``; missing readings are null, empty days give no rows."""
    days = raw.select(F.inline(F.from_json(document, WEATHER_DOCUMENT)["days"]))
    hours = days.select(F.col("datetime").alias("day"), F.inline("hours"))
    return hours.select(*HOURLY_WEATHER.names)


def current_weather(raw: DataFrame, document: str = "document") -> DataFrame:
    """The current conditions of each document that has any."""
    now = F.from_json(document, CURRENT_DOCUMENT)["currentConditions"]
    keep = [name for name in raw.columns if name != document]
    return raw.select(*keep, now.alias("_now")).where("_now IS NOT NULL").select(*keep, "_now.*")


def current_weather_bin(now: DataFrame, as_of: date | str, offset_hours: int = 1) -> DataFrame:
    """Replace the clock time by its hour on ``as_of``, moved by ``offset_hours``."""
    stamp = F.concat_ws(" ", F.lit(str(as_of)), "datetime").try_cast("timestamp_ntz")
    return now.withColumn(BIN, plus_hours(floor_hour(stamp), offset_hours)).drop("datetime")


def weather_bin(hourly: DataFrame, bin: str = BIN) -> DataFrame:
    """Hour key from day and clock time, null where they do not parse; ``day`` is dropped."""
    stamp = F.concat_ws(" ", "day", "datetime").try_cast("timestamp_ntz")
    return hourly.withColumn(bin, stamp).drop("day")


def panel_weather(panel: DataFrame, hourly: DataFrame, bin: str = BIN) -> DataFrame:
    """Attach weather by hour; an hour reported twice yields two rows (see ``dedup_weather``)."""
    return panel.join(small(weather_bin(hourly, bin), "weather"), bin, "left")


def dedup_weather(hourly: DataFrame) -> DataFrame:
    """Keep one reading per (day, clock time), the greatest by its values, for a repeatable choice."""
    readings = [name for name in hourly.columns if name not in ("day", "datetime")]
    return latest_per_key(hourly, ["day", "datetime"], readings)
