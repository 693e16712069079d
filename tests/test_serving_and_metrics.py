from __future__ import annotations

import json
import math
from datetime import datetime

import pytest

from tests.conftest import rows
from zonecast.operators.metrics import best_model, forecast_metrics, joint_rmse
from zonecast.operators.serving import (
    city_header, congestion_level, demand_bands, serving_document, serving_rows, speed_estimate, top_demand,
    top_profit, zone_board, zone_detail, zone_search,
)
from zonecast.plans.serving import dashboard, forecast_hours

NOON = datetime(2024, 1, 20, 12)
PRED = (
    "bin timestamp_ntz, zone_id int, humidity double, precip double, windspeed double, feelslike double, "
    "visibility double, zone_congestion_index double, city_congestion_index double, "
    "target_yellow int, target_green int, target_hvfhv int"
)


def pred(spark, *cases, hour=NOON):
    """(zone, index, yellow, green, hvfhv)"""
    data = [(hour, z, 40.0 + z, 0.0, 1.0, 30.0 + z, 9.0, i, 0.05, y, g, h) for z, i, y, g, h in cases]
    return spark.createDataFrame(data, PRED)


def test_levels_and_speeds(spark):
    df = spark.createDataFrame(
        [(i,) for i in (None, 0.0, 0.0270, 0.0271, 0.0421, 0.05, 0.2)], "zone_congestion_index double"
    )
    got = [(r["congestion_level"], r["speed_estimate"]) for r in speed_estimate(congestion_level(df)).collect()]
    assert [g[0] for g in got] == ["Low", "Low", "Low", "Medium", "Medium", "High", "High"]
    assert (got[0][1], got[5][1], got[6][1]) == (25.0, 15.0, 5.0)


@pytest.mark.parametrize("total,band", [(201, 5), (200, 4), (120, 3), (60, 2), (20, 1), (1, 1), (0, 0)])
def test_demand_bands(spark, total, band):
    assert demand_bands(pred(spark, (1, 0.9, total, 0, 0))).first()["demand_band"] == band


def board(spark):
    zones = spark.createDataFrame(
        [(1, "North Park", "A"), (2, "South Park", "B"), (3, "Pier", "B")], "zone_id int, zone string, borough string"
    )
    return zone_board(zones, pred(spark, (1, 0.1, 10, 20, 30), (2, 0.0, 1, 1, 10)))


def test_board_rankings_and_search(spark):
    made = board(spark).cache()
    assert rows(made, "zone_id", "total_demand", "profit_score") == [(1, 60, 300.0), (2, 12, 120.0), (3, 0, 0.0)]
    assert [r["zone_id"] for r in top_demand(made, 2).collect()] == [1, 2]
    assert [r["zone_id"] for r in top_profit(made).collect()] == [1, 2, 3]
    assert rows(zone_search(made, None, "PARK"), "zone_id") == [(1,), (2,)]
    assert rows(zone_search(made, "B", "park"), "zone_id") == [(2,)]
    assert rows(zone_search(made, "All", ""), "zone_id") == [(1,), (2,), (3,)]
    assert rows(zone_detail(made, 3), "zone") == [("Pier",)]


def test_header_takes_the_first_zone(spark):
    row = city_header(pred(spark, (7, 0.1, 1, 1, 1), (3, 0.1, 2, 2, 2))).first()
    assert (row["total_demand"], row["feelslike"], row["humidity"]) == (9, 33.0, 43.0)
    assert (row["congestion_level"], row["city_speed"]) == ("High", 15.0)
    assert city_header(pred(spark)).count() == 0


def test_serving_rows_fall_back_to_this_hour(spark):
    made = pred(spark, (2, 0.1, 1, 1, 1), (1, 0.1, 2, 2, 2))
    later = datetime(2024, 1, 20, 13)
    assert serving_rows(made, later).count() == 0
    assert [r["zone_id"] for r in serving_rows(made, later, NOON).collect()] == [1, 2]
    assert serving_rows(made, NOON, later).count() == 2


def test_document(spark):
    made = pred(spark, (2, 0.1, 1, 1, 1), (10, 0.1, 2, 2, 2), (1500, 0.1, 3, 3, 3))
    whole = serving_document(made, NOON, "now", zones_per_document=10_000).collect()
    assert len(whole) == 1
    document = json.loads(whole[0]["document"])
    assert document["metadata"] == {
        "generated_at": "now", "total_zones": 3, "prediction_window": "2024-01-20 12:00:00"
    }
    assert list(document["predictions"]) == ["2", "10", "1500"]
    assert document["predictions"]["10"]["target_green"] == 2
    pages = [json.loads(r["document"]) for r in serving_document(made, NOON, "now").orderBy("page").collect()]
    assert [list(p["predictions"]) for p in pages] == [["2", "10"], ["1500"]]
    assert {p["metadata"]["total_zones"] for p in pages} == {3}


def test_dashboard(spark):
    zones = spark.createDataFrame([(1, "Pier", "A")], "zone_id int, zone string, borough string")
    assert forecast_hours(datetime(2024, 1, 20, 12, 40)) == (datetime(2024, 1, 20, 13), NOON)
    tables = dashboard(pred(spark, (1, 0.1, 1, 2, 3)), zones, datetime(2024, 1, 20, 12, 40))
    assert tables["top_demand"].first()["total_demand"] == 6
    assert tables["header"].first()["total_demand"] == 6 and tables["rows"].count() == 1


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 2.0, 5, 5.0), (3, 3.0, 5, 5.0), (5, 3.0, 5, 5.0)], "a int, fa double, b int, fb double")
    got = {r["target"]: r for r in forecast_metrics(df, {"a": "fa", "b": "fb"}).collect()}
    assert got["a"]["rmse"] == pytest.approx(math.sqrt(5 / 3)) and got["a"]["mae"] == pytest.approx(1.0)
    assert got["a"]["r2"] == pytest.approx(1 - 5 / 8)
    assert got["b"]["r2"] == 1.0
    assert got["overall"]["rmse"] == pytest.approx(math.sqrt(5 / 3) / 2)
    missed = forecast_metrics(df.withColumn("fb", df.fb + 1), {"b": "fb"})
    assert missed.where("target = 'b'").first()["r2"] == 0.0
    assert joint_rmse(df, {"a": "fa", "b": "fb"}).first()[0] == pytest.approx(math.sqrt(5 / 6))


def test_best_model(spark):
    report = spark.createDataFrame([("x", 2.0), ("b", 1.0), ("a", 1.0)], "model string, rmse double")
    assert best_model(report).first()["model"] == "a"
