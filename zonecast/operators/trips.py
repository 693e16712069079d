"""Trip-level operators: harmonise feeds, filter, measure, bin."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.times import Moment, elapsed_hours, floor_hour, naive
from zonecast.schemas import BIN, FEEDS

TRIP_COLUMNS = (
    "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid", "trip_miles",
    "trip_duration_hr", "service_type",
)


def normalize_feed(df: DataFrame, feed: str) -> DataFrame:
    """Give one feed the shared trip columns, its duration in hours and its service tag."""
    layout = FEEDS[feed]
    trips = df.withColumnsRenamed(layout.renames)
    if layout.duration_seconds:
        duration = F.col(layout.duration_seconds) / F.lit(3600.0)
    else:
        duration = elapsed_hours(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return trips.withColumns(
        {"trip_duration_hr": duration, "service_type": F.lit(feed)}
    ).select(*TRIP_COLUMNS)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Stack normalized feeds by column name."""
    return reduce(lambda left, right: left.unionByName(right), feeds)


def window_filter(trips: DataFrame, start: Moment, end: Moment, ts: str = "pickup_datetime") -> DataFrame:
    """Trips picked up from ``start`` to the end of the day ``end``.

    The column stays bare in the predicate, so it reaches the file scan.
    """
    after = naive(end) + F.lit(timedelta(days=1))
    return trips.where((F.col(ts) >= naive(start)) & (F.col(ts) < after))


def valid_trips(trips: DataFrame, lo: float = 1.0, hi: float = 60.0) -> DataFrame:
    """Trips of positive duration and plausible speed, with their speed in ``mph``."""
    kept = trips.where((F.col("trip_duration_hr") > 0) & (F.col("trip_miles") >= 0))
    speed = F.try_divide(F.col("trip_miles"), F.col("trip_duration_hr"))
    return kept.withColumn("mph", speed).where(F.col("mph").between(lo, hi))


def hour_bin(df: DataFrame, ts: str = "pickup_datetime", bin: str = BIN) -> DataFrame:
    return df.withColumn(bin, floor_hour(F.col(ts)))
