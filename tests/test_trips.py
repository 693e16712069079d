from __future__ import annotations

import math
from datetime import datetime

from tests.conftest import rows
from zonecast.operators.panel import hourly_targets, panel_full, trip_counts, zone_speed
from zonecast.operators.profiling import narrow_types, profile_columns
from zonecast.operators.trips import hour_bin, normalize_feed, union_feeds, valid_trips, window_filter
from zonecast.schemas import FEEDS

T = datetime


def yellow(spark, *trips):
    return spark.createDataFrame(list(trips), FEEDS["yellow"].schema)


def test_duration_keeps_fractions_of_a_second(spark):
    feed = yellow(spark, (T(2024, 1, 1), T(2024, 1, 1, 0, 0, 1, 500000), 1, 2, 1.0))
    assert normalize_feed(feed, "yellow").first()["trip_duration_hr"] == 1.5 / 3600


def test_seconds_feed_uses_its_own_duration(spark):
    row = (T(2024, 1, 1), T(2024, 1, 1, 9), 1, 2, 1.0, 1800)
    feed = spark.createDataFrame([row], FEEDS["hvfhv"].schema)
    assert normalize_feed(feed, "hvfhv").first()["trip_duration_hr"] == 0.5


def test_feeds_stack_by_name(spark):
    feed = yellow(spark, (T(2024, 1, 1), T(2024, 1, 1, 1), 1, 2, 3.0))
    one = normalize_feed(feed, "yellow")
    stacked = union_feeds(one, one.select(*reversed(one.columns)))
    assert stacked.select("trip_miles").distinct().count() == 1


def test_window_ends_after_its_last_day(spark):
    stamps = [T(2023, 12, 31, 23, 59), T(2024, 1, 1), T(2024, 1, 31, 23, 59, 59), T(2024, 2, 1), None]
    df = spark.createDataFrame([(s,) for s in stamps], "pickup_datetime timestamp_ntz")
    assert rows(window_filter(df, "2024-01-01", "2024-01-31")) == [(stamps[1],), (stamps[2],)]


def test_speed_limits_are_inclusive_and_bad_rows_drop(spark):
    cases = [(1.0, 1.0), (1.0, 60.0), (1.0, 60.1), (1.0, 0.9), (0.0, 5.0), (-1.0, 5.0), (1.0, -1.0),
             (None, 5.0), (1.0, None), (1.0, math.nan), (math.nan, 1.0)]
    df = spark.createDataFrame(cases, "trip_duration_hr double, trip_miles double")
    assert rows(valid_trips(df), "mph") == [(1.0,), (60.0,)]


def trips(spark, *cases):
    """Trips as (day, hour, zone, service, mph)."""
    data = [(T(2024, 1, d, h, 5), z, s, m) for d, h, z, s, m in cases]
    return hour_bin(
        spark.createDataFrame(data, "pickup_datetime timestamp_ntz, pulocationid int, service_type string, mph double")
    )


def test_panel_of_a_hand_made_day(spark):
    made = trips(
        spark,
        (1, 0, 1, "yellow", 10.0), (1, 0, 1, "yellow", 20.0), (1, 0, 2, "green", 30.0),
        (1, 3, 1, "hvfhv", 8.0),
    )
    got = rows(panel_full(made))
    zero, three = T(2024, 1, 1), T(2024, 1, 1, 3)
    assert got == [
        (zero, 1, 2, 0, 0, 20.0, 0.05, 15.0, 0.067),
        (zero, 2, 0, 1, 0, 20.0, 0.05, 30.0, 0.033),
        (three, 1, 0, 0, 1, 8.0, 0.125, 8.0, 0.125),
        (three, 2, 0, 0, 0, 8.0, 0.125, 8.0, 0.125),
    ]


def test_missing_hours_take_the_mean_of_the_city_hours(spark):
    made = trips(spark, (1, 0, 1, "yellow", 10.0), (1, 2, 1, "yellow", 20.0), (1, 2, 1, "yellow", 40.0))
    got = {r["bin"].hour: r["zone_avg_speed"] for r in zone_speed(made).collect()}
    assert got == {0: 10.0, 1: 20.0, 2: 30.0}


def test_a_service_without_trips_still_has_its_column(spark):
    made = trips(spark, (1, 0, 1, "yellow", 10.0))
    assert rows(hourly_targets(made)) == [(T(2024, 1, 1), 1, 1, 0, 0)]


def test_no_trips_give_an_empty_panel(spark):
    assert panel_full(trips(spark, (1, 0, 1, "yellow", 1.0)).where("false")).count() == 0


def test_a_hot_cell_counts_every_trip(spark):
    made = trips(spark, (1, 0, 7, "yellow", 10.0)).crossJoin(spark.range(30_000))
    made = made.unionByName(trips(spark, (1, 0, 1, "green", 30.0)), allowMissingColumns=True)
    assert rows(trip_counts(made), "zone_id", "trip_count") == [(1, 1), (7, 30_000)]
    assert rows(panel_full(made), "zone_id", "target_yellow", "target_green") == [(1, 0, 1), (7, 30_000, 0)]


def test_profile_and_narrowing(spark):
    df = spark.createDataFrame(
        [(1, 300, 2**40, 1.5, "a", "x"), (2, -300, 1, None, "a", "y"), (3, 0, 0, 2.0, "a", None)],
        "t bigint, s bigint, b bigint, f double, c string, u string",
    )
    kinds = {r["column_name"]: r["narrow_type"] for r in profile_columns(df).collect()}
    assert kinds == {"t": "tinyint", "s": "smallint", "b": "bigint", "f": "float", "c": "category", "u": "string"}
    assert dict(narrow_types(df).dtypes)["s"] == "smallint"


def test_narrowing_keeps_values(spark):
    df = spark.createDataFrame([(123456.78, 0.1, None), (1.0, 2.5, None)], "price double, share double, none double")
    kinds = dict(narrow_types(df).dtypes)
    assert kinds == {"price": "double", "share": "float", "none": "double"}
    assert narrow_types(df).agg({"price": "max"}).first()[0] == 123456.78
