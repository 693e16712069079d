"""Physical plans, and agreement of composed operators with the composed job."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks import tables
from checks.compare import differences
from zonecast.operators import calendars
from zonecast.operators.lags import city_demand, lag_features
from zonecast.operators.panel import hourly_targets, panel_full, trip_cells, zone_speed
from zonecast.operators.spatial import neighbor_demand, zone_adjacency
from zonecast.operators.weather import panel_weather
from zonecast.plans.features import clean_trips, feature_panel
from zonecast.schemas import TARGETS
from zonecast.session import planned_bytes, small, stage

ROOT = Path(__file__).resolve().parent.parent


def plan_of(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_equals_its_operators(spark, sf_dir):
    trips, weather = tables.trips(spark, sf_dir), tables.hourly_weather(spark, sf_dir)
    edges = stage(zone_adjacency(tables.polygons(spark, sf_dir)), "edges")
    composed = city_demand(stage(panel_full(trips), "panel"))
    composed = lag_features(neighbor_demand(composed, edges))
    composed = calendars.calendar_features(panel_weather(composed, weather))
    panel = feature_panel(trips, weather, edges)
    assert differences(panel.toPandas(), composed.toPandas()) == []
    assert panel.count() > 0


@pytest.mark.parametrize("name", ["feature_panel", "zone_road_speed", "zone_adjacency", "score_linear", "zone_board"])
def test_no_python_and_no_unkeyed_join(spark, sf_dir, name):
    plan = plan_of(queries()[name](spark, sf_dir))
    for operator in ("PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas", "MapInArrow"):
        assert operator not in plan


def test_lags_share_one_window_and_the_shuffle_by_zone(spark, sf_dir):
    edges = stage(zone_adjacency(tables.polygons(spark, sf_dir)), "edges")
    panel = feature_panel(tables.trips(spark, sf_dir), tables.hourly_weather(spark, sf_dir), edges)
    plan = panel._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bWindow \[", plan)) == 1
    above = plan[plan.index("Window ["):]
    assert "Exchange hashpartitioning(zone_id" in above
    assert above.index("HashAggregate") < above.index("Exchange hashpartitioning(zone_id")
    assert "REPARTITION_BY_COL" in plan


def test_trip_filters_reach_the_scan_and_counts_combine_before_the_shuffle(spark, sf_dir, capsys):
    trips = clean_trips(tables.feeds(spark, sf_dir), "2024-01-05", "2024-01-20")
    trip_cells(trips).explain("formatted")
    plan = capsys.readouterr().out
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1 and "partial_count" in plan
    scans = re.findall(r"ReadSchema: (\S+)", plan)
    assert len(scans) == 3 and all("props" not in s for s in scans)
    assert "EqualTo(event_type,click)" in plan and "In(event_type, [" in plan
    assert plan.count("GreaterThanOrEqual(ts,2024-01-05T00:00), LessThan(ts,2024-01-21T00:00)") == 3


def test_small_side_checks_its_size(spark, monkeypatch, tmp_path):
    import zonecast.session as session

    df = spark.range(1000)
    assert planned_bytes(df) > 0
    hinted = lambda side: "ResolvedHint" in side._jdf.queryExecution().analyzed().toString()
    assert hinted(small(df, "t"))
    monkeypatch.setattr(session, "BROADCAST_BYTES", 1)
    side = small(df, "t")
    assert not hinted(side) and side.count() == 1000


def test_side_of_few_bytes_and_many_rows_is_not_broadcast(spark, monkeypatch):
    """Files of equal values are small; what a broadcast holds is rows."""
    import zonecast.session as session

    side = stage(spark.range(20000).select(F.col("id") * 0, F.lit("x")), "side")
    limit = planned_bytes(side) + 1
    assert limit < 20000 * 32
    monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(session, "COUNTED_BYTES", 1)
    hints = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "strategy=merge" in hints(small(side, "t"))
    monkeypatch.setattr(session, "BROADCAST_BYTES", 64 << 20)
    assert "strategy=broadcast" in hints(small(side, "t"))


def test_tasks_of_the_panel_grow_with_its_rows(spark, sf_dir, monkeypatch):
    import zonecast.session as session

    trips, weather = tables.trips(spark, sf_dir), tables.hourly_weather(spark, sf_dir)
    edges = stage(zone_adjacency(tables.polygons(spark, sf_dir)), "edges")
    few = [feature_panel(trips, weather, edges), lag_features(hourly_targets(trips), TARGETS), zone_speed(trips)]
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    many = [feature_panel(trips, weather, edges), lag_features(hourly_targets(trips), TARGETS), zone_speed(trips)]
    for one, other in zip(few, many):
        assert differences(one.toPandas(), other.toPandas()) == []
        widths = re.findall(r"Exchange hashpartitioning\(zone_id#\d+, (\d+)\), REPARTITION_BY_NUM", other._jdf.queryExecution().executedPlan().toString())
        assert max(map(int, widths)) > 10


def test_every_query_reads_whole_tables():
    """No sampling and no row caps beyond the operators that are caps."""
    allowed = {"scoring.py", "serving.py", "metrics.py", "store.py"}
    for path in (ROOT / "zonecast").rglob("*.py"):
        if path.parent.name == "llm":
            continue  # its bounded samples of labelled rows have their own tests
        text = path.read_text()
        assert ".sample(" not in text and "localCheckpoint" not in text
        if path.name not in allowed:
            assert ".limit(" not in text, path
