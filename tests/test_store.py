from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from zonecast.functions.times import hour_text
from zonecast.operators.keyed import latest_per_key
from zonecast.plans.scoring import store_forecast
from zonecast.sources.store import (
    MONTHS, _existing, _in_partitions, append_delta, append_predictions, backfill_months, prediction_schema, read_features,
    read_table, upsert_features, with_months,
)
from zonecast.sources.versions import VersionConflict, commit, compact, newest, next_version


def hours(spark, *cases):
    """(month, day, zone, value)"""
    data = [(datetime(2024, m, d), z, v) for m, d, z, v in cases]
    df = spark.createDataFrame(data, "bin timestamp_ntz, zone_id int, v int")
    return with_months(df).withColumn("bin_str", hour_text(df.bin))


def test_upsert_replaces_by_key_and_repeats_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_features(hours(spark, (1, 1, 1, 10), (1, 2, 1, 20), (2, 1, 1, 30)), path)
    later = hours(spark, (1, 2, 1, 21), (1, 3, 1, 40), (3, 1, 1, 50))
    expected = [(10,), (21,), (30,), (40,), (50,)]
    assert rows(upsert_features(later, path), "v") == expected
    assert rows(upsert_features(later, path), "v") == expected


def test_tasks_of_a_write_grow_with_its_rows(spark, tmp_path, monkeypatch):
    import zonecast.session as session
    from zonecast.sources import store

    path, key, seen = str(tmp_path / "t"), "spark.sql.shuffle.partitions", []
    width = spark.conf.get(key)
    noted = lambda *given: (seen.append(int(spark.conf.get(key))), latest_per_key(*given))[1]
    monkeypatch.setattr(store, "latest_per_key", noted)
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    upsert_features(hours(spark, *[(1, 1 + i % 28, i, i) for i in range(100)]), path)
    merged = upsert_features(hours(spark, *[(1, 1 + i % 28, i, i + 1000) for i in range(50, 250)]), path)
    assert rows(merged, "v") == [(i,) for i in (*range(50), *range(1050, 1250))]
    assert seen == [10, 20] and spark.conf.get(key) == width and spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path = tmp_path / "t"
    upsert_features(hours(spark, (1, 1, 1, 10), (2, 1, 1, 30)), str(path))
    before = newest(spark, str(path)).folders
    upsert_features(hours(spark, (1, 1, 1, 11)), str(path))
    after = newest(spark, str(path)).folders
    changed = {part for part in after if after[part] != before[part]}
    assert changed == {"pickup_year=2024/pickup_month=1"} and len(after) == 2


def test_several_new_rows_of_a_key_follow_the_order(spark, tmp_path):
    copies = hours(spark, (1, 1, 1, 5)).crossJoin(spark.range(20_000).withColumnRenamed("id", "seq"))
    got = upsert_features(copies, str(tmp_path / "t"), order_by=["seq"])
    assert rows(got, "v", "seq") == [(5, 19_999)]


def test_upsert_takes_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_features(hours(spark, (1, 1, 1, 10)), path)
    wider = hours(spark, (1, 2, 1, 20)).withColumn("w", F.lit(7))
    upsert_features(wider, path)
    merged = upsert_features(hours(spark, (1, 3, 1, 30)), path)
    assert rows(merged, "v", "w") == [(10, None), (20, 7), (30, None)]


def test_read_prunes_months_and_closes_the_range(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_features(hours(spark, (1, 31, 1, 1), (2, 1, 1, 2), (2, 9, 1, 3), (3, 1, 1, 4)), path)
    got = read_features(spark, path, ["bin", "v"], "2024-02-01", "2024-02-09")
    assert rows(got, "v") == [(2,), (3,)]
    left = read_features(spark, path, ["bin", "v"], "2024-02-01", "2024-02-09", closed="left")
    assert rows(left, "v") == [(2,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "pickup_month" in partition_filters
    assert "GreaterThanOrEqual(bin," in plan and "LessThanOrEqual(bin," in plan
    with pytest.raises(ValueError):
        read_features(spark, path, ["v"], closed="right")


def test_read_strips_the_prefix(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_features(hours(spark, (1, 1, 1, 1)).withColumnRenamed("v", "store_v"), path)
    assert rows(read_features(spark, path, ["v"], prefix="store_")) == [(1,)]


def test_prediction_log(spark, tmp_path):
    path = str(tmp_path / "log")
    first = prediction_schema(hours(spark, (1, 2, 1, 100)).drop("bin_str"))
    hist = prediction_schema(hours(spark, (1, 1, 1, 1), (1, 2, 1, 2)).drop("bin_str"))
    assert rows(append_predictions(first, hist, path), "v") == [(1,), (100,)]
    second = prediction_schema(hours(spark, (1, 3, 1, 300)))
    later = hist.withColumn("v", hist.v * 0)
    assert rows(append_predictions(second, later, path), "v") == [(1,), (100,), (300,)]
    assert dict(read_table(spark, path).dtypes)["zone_id"] == "int"
    got = read_features(spark, path, ["v"], "2024-01-02", "2024-01-02 23:00:00")
    assert rows(got) == [(100,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "bin_date" in plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]


def test_forecasts_reach_the_log(spark, tmp_path):
    cols = {"humidity": F.lit(40.0), "target_yellow": F.lit(3), "target_yellow_lag_1h": F.lit(9.0)}
    base = hours(spark, (1, 2, 1, 0)).select("bin", "zone_id").withColumns(cols)
    before = hours(spark, (1, 1, 1, 0)).select("bin", "zone_id").withColumns(cols)
    log = store_forecast(base, before, str(tmp_path / "log"))
    assert log.count() == 2 and "target_yellow_lag_1h" not in log.columns
    assert dict(log.dtypes)["target_yellow"] == "double"


def test_backfill_covers_whole_months(spark, tmp_path):
    days = [datetime(2023, 12, 31, 23), datetime(2024, 1, 1), datetime(2024, 2, 29, 23, 59), datetime(2024, 3, 1)]
    trips = spark.createDataFrame([(d,) for d in days], "pickup_datetime timestamp_ntz")
    got = backfill_months(trips, "2024-01-01", "2024-02-10", str(tmp_path / "m"))
    assert rows(got, "year", "month") == [(2024, 1), (2024, 2)]


def test_backfill_repeats_one_month_without_losing_others(spark, tmp_path):
    path = str(tmp_path / "m")
    days = [(datetime(2024, 1, 5) + timedelta(days=30 * i),) for i in range(3)]
    trips = spark.createDataFrame(days, "pickup_datetime timestamp_ntz")
    backfill_months(trips, "2024-01-01", "2024-03-31", path)
    assert backfill_months(trips, "2024-02-01", "2024-02-01", path).count() == 3


def test_upsert_keeps_rows_without_partition_or_key(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "zone_id int, bin_str string, v int, pickup_year int, pickup_month int"
    table = lambda *rows_: spark.createDataFrame(rows_, schema)
    upsert_features(table((1, "a", 1, None, None), (2, "b", 2, 2024, 1), (None, "c", 3, None, 2)), path)
    got = upsert_features(table((3, "d", 4, None, None), (None, "c", 5, None, 2)), path)
    assert rows(got, "v") == [(1,), (2,), (4,), (5,)]


def test_upsert_reads_the_touched_folders_only(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_features(hours(spark, (1, 1, 1, 1), (2, 1, 1, 2), (3, 1, 1, 3)), path)
    touched = spark.createDataFrame([(2024, 2)], "pickup_year int, pickup_month int")
    stored = _in_partitions(_existing(spark, path), touched, MONTHS)
    assert rows(stored, "v") == [(2,)]
    plan = stored._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "pickup_month" in filters and "pickup_year" in filters


def test_upsert_widens_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_features(hours(spark, (1, 1, 1, 1)), path)
    got = upsert_features(hours(spark, (2, 1, 1, 2)).withColumn("w", F.col("v") * 10), path)
    assert rows(got, "v", "w") == [(1, None), (2, 20)]
    assert rows(upsert_features(hours(spark, (3, 1, 1, 3)), path), "v", "w") == [(1, None), (2, 20), (3, None)]


def test_one_row_per_key_sorts_once(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 3, "b"), (2, None, "c")], "k int, o int, v string")
    latest = latest_per_key(df, ["k"], ["o"])
    assert rows(latest, "v") == [("b",), ("c",)]
    assert "SortAggregate" not in latest._jdf.queryExecution().executedPlan().toString()


def test_reading_columns_added_later(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_features(hours(spark, (1, 1, 1, 1)), path)
    upsert_features(hours(spark, (2, 1, 1, 2)).withColumn("y", F.col("v") * 10), path)
    assert rows(read_features(spark, path, ["zone_id", "v", "y"], "2024-01-01", "2024-03-01")) == [(1, 1, None), (1, 2, 20)]


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "t")
    before = upsert_features(hours(spark, (1, 1, 1, 1), (2, 1, 1, 2)), path)
    upsert_features(hours(spark, (1, 1, 1, 10), (2, 1, 1, 20)), path)
    append_delta(hours(spark, (1, 1, 1, 100)), path)
    assert rows(before, "v") == [(1,), (2,)] and rows(read_table(spark, path), "v") == [(20,), (100,)]
    # A write that never got to its manifest is not seen.
    hours(spark, (1, 1, 1, 7)).write.partitionBy(*MONTHS).parquet(f"{path}/_write=lost")
    assert rows(read_table(spark, path), "v") == [(20,), (100,)]


def test_the_second_of_two_writers_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_features(hours(spark, (1, 1, 1, 1)), path)
    late = next_version(newest(spark, path), hours(spark).schema, ("zone_id", "bin_str"), MONTHS)
    upsert_features(hours(spark, (1, 1, 1, 2)), path)
    with pytest.raises(VersionConflict):
        commit(spark, path, late)
    assert rows(read_table(spark, path), "v") == [(2,)] and newest(spark, path).number == 2
    with pytest.raises(ValueError):
        upsert_features(hours(spark, (1, 1, 1, 3)), path, keys=("zone_id",))


def test_deltas_merge_on_reading_and_compact(spark, tmp_path):
    path = str(tmp_path / "t")
    append_delta(hours(spark, (1, 1, 1, 1), (1, 2, 1, 2), (2, 1, 1, 3)), path, source="a", batch=0)
    append_delta(hours(spark, (1, 2, 1, 20)).withColumn("w", F.lit(5)), path, source="a", batch=1)
    append_delta(hours(spark, (1, 2, 1, 200)), path, source="a", batch=1)  # repeated: changes nothing
    append_delta(hours(spark, (1, 3, 1, 4), (2, 1, 1, 30)), path, source="b", batch=0)
    wanted = [(1, None), (4, None), (20, 5), (30, None)]
    assert rows(read_table(spark, path), "v", "w") == wanted
    assert {part: len(held) for part, held in newest(spark, path).folders.items()} == {"pickup_year=2024/pickup_month=1": 3, "pickup_year=2024/pickup_month=2": 2}
    assert compact(spark, path, 2).number == 4 and compact(spark, path, 2) is None
    assert rows(read_table(spark, path), "v", "w") == wanted
    assert sorted(len(held) for held in newest(spark, path).folders.values()) == [1, 2]
    compact(spark, path)
    assert rows(read_table(spark, path), "v", "w") == wanted
    assert rows(upsert_features(hours(spark, (1, 1, 1, 11)), path), "v") == [(4,), (11,), (20,), (30,)]


def test_plain_folders_become_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    hours(spark, (1, 1, 1, 1), (2, 1, 1, 2)).write.partitionBy(*MONTHS).parquet(path)
    assert rows(upsert_features(hours(spark, (2, 1, 1, 20)), path), "v") == [(1,), (20,)]
