from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tests.conftest import rows
from zonecast.operators.lags import city_demand, dedup_history, lag_features, serving_lags
from zonecast.operators.positions import chronological_split, zone_positions
from zonecast.schemas import CITY_DEMAND, NEIGHBOR_DEMAND, TARGETS

START = datetime(2024, 1, 30)


def series(spark, zone_hours):
    """(zone, list of hours) pairs; the value is zone * 1000 + hour."""
    data = [
        (START + timedelta(hours=h), z, z * 1000 + h) for z, hours in zone_hours for h in hours
    ]
    return spark.createDataFrame(data, "bin timestamp_ntz, zone_id int, v int")


def lagged(df, **options):
    got = lag_features(df, ["v"], **options)
    return {(r["zone_id"], r["bin"]): (r["v_lag_1h"], r["v_lag_24h"]) for r in got.collect()}


def test_row_lags_skip_missing_hours_and_time_lags_do_not(spark):
    df = series(spark, [(1, [0, 1, 3, *range(10, 40)])])
    by_rows, by_time = lagged(df), lagged(df, mode="time")
    at = lambda h: (1, START + timedelta(hours=h))
    assert by_rows[at(0)] == (0, 0) and by_time[at(0)] == (0, 0)
    assert by_rows[at(3)] == (1001, 0) and by_time[at(3)] == (0, 0)
    # The 24th row before hour 33 (place 26) is place 2, hour 3; hour 9 has no row.
    assert by_rows[at(33)] == (1032, 1003) and by_time[at(33)] == (1032, 0)
    assert by_rows[at(34)] == (1033, 1010) and by_time[at(34)] == (1033, 1010)


@pytest.mark.parametrize("block", [24, 25, 100])
def test_blocks_equal_one_window(spark, block):
    df = series(spark, [(1, range(0, 230, 3)), (2, range(5)), (3, [0]), (4, range(170))])
    assert lagged(df, block_rows=block) == lagged(df)


def test_blocks_must_cover_the_longest_lag(spark):
    with pytest.raises(ValueError):
        lagged(series(spark, [(1, [0])]), block_rows=10)


def test_carry_in_feeds_the_first_lags_only(spark):
    earlier = series(spark, [(1, range(0, 24))])
    later = series(spark, [(1, range(24, 30))])
    got = lagged(later, carry_in=earlier)
    assert len(got) == 6
    assert got[(1, START + timedelta(hours=24))] == (1023, 1000)


def test_city_demand_sums_zones(spark):
    df = series(spark, [(1, [0, 1]), (2, [0])])
    got = rows(city_demand(df, ["v"]), "bin", "zone_id", "v_city_hour_pickups")
    assert [r[2] for r in got] == [3000, 3000, 1001]


def test_history_wins_over_a_candidate(spark):
    history = series(spark, [(1, [0, 1])])
    candidates = series(spark, [(1, [1, 2])]).selectExpr("bin", "zone_id", "-v AS v")
    assert rows(dedup_history(history, candidates), "v") == [(-1002,), (1000,), (1001,)]


def test_serving_lags_fill_lags_only(spark):
    names = [*TARGETS, *CITY_DEMAND, *NEIGHBOR_DEMAND]
    history = series(spark, [(1, range(24))]).selectExpr(
        "bin", "zone_id", "CAST(NULL AS DOUBLE) AS humidity", *[f"CAST(v AS DOUBLE) AS {n}" for n in names]
    )
    ahead = series(spark, [(1, [24])]).selectExpr("bin", "zone_id", "2.5 AS humidity")
    got = serving_lags(history, ahead).orderBy("bin").collect()
    assert len(got) == 25
    last = got[-1]
    assert (last["target_green"], last["humidity"]) == (None, 2.5)
    assert (last["target_green_lag_1h"], last["target_green_lag_24h"]) == (1023.0, 1000.0)
    assert last["target_green_city_hour_pickups_lag_1h"] == 1023.0
    assert last["neighbor_pickups_target_green_lag_1h"] == 1023.0
    assert "target_green_city_hour_pickups_lag_24h" not in got[0].asDict()
    assert got[0]["humidity"] is None and got[0]["target_green_lag_1h"] == 0.0


def test_split_sizes_and_order(spark):
    df = series(spark, [(1, range(20)), (2, range(0, 3000, 300)), (3, [5])])
    got = chronological_split(df).collect()
    counts = {}
    for r in got:
        counts.setdefault(r["zone_id"], {"train": 0, "val": 0, "test": 0})[r["split"]] += 1
    assert counts == {
        1: {"train": 14, "val": 3, "test": 3},
        2: {"train": 7, "val": 1, "test": 2},
        3: {"train": 0, "val": 0, "test": 1},
    }
    place = {"train": 0, "val": 1, "test": 2}
    for zone in counts:
        parts = [place[r["split"]] for r in sorted(got, key=lambda r: r["bin"]) if r["zone_id"] == zone]
        assert parts == sorted(parts)


def test_positions_run_over_months(spark):
    df = series(spark, [(1, range(0, 2400, 100))])
    got = sorted((r["bin"], r["_rn"], r["_n"]) for r in zone_positions(df).collect())
    assert [r[1] for r in got] == list(range(1, 25)) and {r[2] for r in got} == {24}


def test_rows_of_one_hour_have_a_fixed_order(spark):
    data = [(START + timedelta(hours=h), 1, v) for h, v in ((0, 5), (0, 7), (1, 1), (1, 2), (2, 3))]
    one = spark.createDataFrame(data, "bin timestamp_ntz, zone_id int, v int")
    other = spark.createDataFrame(data[::-1], "bin timestamp_ntz, zone_id int, v int")
    expected = [(1, 7), (2, 1), (3, 2), (5, 0), (7, 5)]
    for df in (one, other):
        assert rows(lag_features(df, ["v"], (1,)), "v", "v_lag_1h") == expected
        assert rows(lag_features(df, ["v"], (1,), block_rows=2), "v", "v_lag_1h") == expected
        assert rows(zone_positions(df), "_rn", "v") == [(1, 5), (2, 7), (3, 1), (4, 2), (5, 3)]
