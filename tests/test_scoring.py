from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from zonecast.operators.scoring import (
    _gram_size, borough_speed, candidate_rows, clean_forecast, history_fallback, history_window, latest_readings,
    score_linear, scoring_frame, serving_congestion, zone_lookup, zone_road_speed,
)

AS_OF = datetime(2024, 1, 20, 12, 10)
NOON = datetime(2024, 1, 20, 12)


def panel(spark, *stamps):
    return spark.createDataFrame([(s, i) for i, s in enumerate(stamps)], "bin timestamp_ntz, v int")


def test_window_is_the_day_before_the_target_hour(spark):
    df = panel(spark, NOON - timedelta(hours=25), NOON - timedelta(hours=24), NOON - timedelta(hours=1), NOON)
    assert rows(history_window(df, AS_OF), "v") == [(1,), (2,)]
    late = AS_OF.replace(minute=50)
    assert rows(history_window(df, late), "v") == [(2,), (3,)]


def test_fallback_applies_only_to_an_empty_window(spark):
    df = panel(spark, NOON - timedelta(hours=2), datetime(2024, 2, 29, 3))
    later = datetime(2025, 1, 20, 12, 10)
    moved = history_fallback(history_window(df, later), df, later)
    assert rows(moved) == [(datetime(2025, 1, 20, 10), 0)]
    recent = history_window(df, AS_OF)
    assert rows(history_fallback(recent, df, AS_OF)) == [(datetime(2024, 1, 20, 10), 0)]
    shifted = history_fallback(recent, df, AS_OF, always_shift=True)
    assert rows(shifted) == [(datetime(2025, 1, 20, 10), 0)]
    leap = datetime(2025, 3, 1, 10, 0)
    assert rows(history_fallback(history_window(df, leap), df, leap)) == [(datetime(2025, 2, 28, 3), 1)]


def test_candidates_need_weather(spark):
    history = spark.createDataFrame([(1,), (2,), (1,)], "zone_id int")
    weather = spark.createDataFrame([(NOON, 40.0)], "bin timestamp_ntz, humidity double")
    assert rows(candidate_rows(history, weather)) == [(1, NOON, 40.0), (2, NOON, 40.0)]
    assert candidate_rows(history, weather.where("false")).count() == 0


def test_lookup_keeps_unknown_zones(spark):
    lookup = spark.createDataFrame([(1, "A", "N")], "locationid int, zone string, borough string")
    df = spark.createDataFrame([(1,), (9,)], "zone_id int")
    assert rows(zone_lookup(df, lookup)) == [(1, "A", "N"), (9, None, None)]


FEED = "link_name string, borough string, speed string, data_as_of bigint"


def road(spark, zones, feed):
    zones = spark.createDataFrame(zones, "zone_id int, zone string, borough string")
    return dict(rows(zone_road_speed(zones, spark.createDataFrame(feed, FEED))))


def test_road_speed_rules(spark):
    feed = [
        ("Harbor Park nb", "N", "10", 1), ("HARBOR PARK sb", "N", "30", 2), ("park park", "N", "50", 3),
        ("closed bridge", "S", "n/a", 4), ("closed bridge", "S", None, 5), (None, "S", "8", 6),
        ("a.c", "S", "4", 7), ("abc", "S", "6", 8),
    ]
    zones = [
        (1, "harbor park", "N"), (2, "Park", "N"), (3, "Bridge", "S"), (4, "Nowhere", "S"), (5, "", "N"),
        (6, None, "S"), (7, "Nowhere", "X"), (8, "a.c", "N"), (9, "Park", "S"),
    ]
    got = road(spark, zones, feed)
    assert got == {
        1: 20.0, 2: 30.0, 3: None, 4: 6.0, 5: 30.0, 6: 6.0, 7: None, 8: 4.0, 9: 30.0,
    }


def test_road_speed_against_brute_force(spark):
    names = ["a", "ab", "b", "ba", "aab", "c", "bcb", "abcabc", "zz"]
    feed = [(f"{x}{y}{x}", "N", str(i), i) for i, (x, y) in enumerate((x, y) for x in names for y in names)]
    zones = [(i, n.upper(), "N") for i, n in enumerate(names)]
    got = road(spark, zones, feed)
    for i, n in enumerate(names):
        hits = [float(s) for link, _, s, _ in feed if n in link]
        assert got[i] == pytest.approx(sum(hits) / len(hits))


def test_road_speed_of_long_names(spark):
    links = ["the long straight road north", "the long straight road south", "long road", "straight roa", "th"]
    feed = [(link.title(), "N", str(10 * i), i) for i, link in enumerate(links)] * 2
    zones = ["straight road", "LONG STRAIGHT ROAD NORTH", "roadx", "oa", "t", "zzz road", "road", "the long straight road north and on"]
    got = road(spark, [(i, z, "N") for i, z in enumerate(zones)], feed)
    assert got == {0: 5.0, 1: 0.0, 2: 20.0, 3: 15.0, 4: 20.0, 5: 20.0, 6: 10.0, 7: 20.0}


def test_road_speed_index_joins_by_shuffle_and_by_over_half_a_name(spark):
    """The index has many times the links' size, which plans know nothing of: a broadcast of it ended the driver."""
    feed = [(f"ramp zone {i} nb", "N", str(i % 60), i) for i in range(1000, 1600)]
    zones = spark.createDataFrame([(i, f"Zone {i}", "N") for i in range(1000, 1600)], "zone_id int, zone string, borough string")
    found = zone_road_speed(zones, spark.createDataFrame(feed, FEED))
    assert dict(rows(found)) == {i: float(i % 60) for i in range(1000, 1600)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    pairs = [line for line in plan.splitlines() if re.search(r"Join \[gram", line)]
    assert pairs and all("SortMergeJoin" in line for line in pairs)
    sizes = spark.createDataFrame([(n, "x" * n) for n in (1, 2, 3, 8, 15, 64, 300)], "n int, name string")
    assert rows(sizes.select("n", _gram_size(F.col("name")))) == [(1, 1), (2, 2), (3, 2), (8, 8), (15, 8), (64, 64), (300, 64)]


def test_borough_speed_skips_unreadable(spark):
    feed = spark.createDataFrame([("l", "N", "10", 1), ("l", "N", "x", 2), ("l", "S", "", 3)], FEED)
    assert rows(borough_speed(feed)) == [("N", 10.0), ("S", None)]
    assert rows(latest_readings(feed, 2), "data_as_of") == [(2,), (3,)]


def test_congestion_fallbacks(spark):
    one, two = NOON, NOON + timedelta(hours=1)
    data = [(one, 1, 10.0), (one, 2, 30.0), (one, 3, None), (one, 4, 0.0), (two, 1, None)]
    df = spark.createDataFrame(data, "bin timestamp_ntz, zone_id int, zone_avg_speed double")
    got = {(r["bin"], r["zone_id"]): r for r in serving_congestion(df).collect()}
    city = (10 + 30 + 0) / 3
    overall = city  # the mean over rows of the known city means
    filled = (10 + 30 + city + 0 + overall) / 5
    index = lambda key: (got[key]["city_congestion_index"], got[key]["zone_congestion_index"])
    assert index((one, 1)) == pytest.approx((1 / city, 1 / 10))
    assert index((one, 3)) == pytest.approx((1 / city, 1 / city))
    assert index((one, 4)) == pytest.approx((1 / city, 1 / filled))
    assert index((two, 1)) == pytest.approx((1 / overall, 1 / overall))
    assert "zone_avg_speed" not in serving_congestion(df).columns


def test_forecasts_are_clipped_and_rounded_half_even(spark):
    df = spark.createDataFrame([(v,) for v in (-3.2, 0.5, 1.5, 2.5, 2.51)], "f double")
    assert rows(clean_forecast(df, ["f"])) == [(0,), (0,), (2,), (2,), (3,)]
    linear = score_linear(df, {"t": {"f": 2.0, "intercept": 1.0}})
    assert [r["t"] for r in linear.orderBy("f").collect()] == [0, 2, 4, 6, 6]


def test_scoring_frame_keeps_the_target_hour_and_hides_the_unknown(spark):
    df = spark.createDataFrame(
        [(NOON, 1, 5, 2.0), (AS_OF, 1, 5, 2.0)],
        "bin timestamp_ntz, zone_id int, target_green int, zone_avg_speed double",
    )
    assert rows(scoring_frame(df, NOON)) == [(NOON, 1)]
