from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from checks import tables
from checks.model_queries import stream_of
from tests.conftest import rows
from zonecast.functions.times import hour_text
from zonecast.operators.panel import trip_counts
from zonecast.sources.store import read_table, with_months
from zonecast.sources.versions import newest
from zonecast.streaming.hourly import stream_hourly, write_keyed

KEYS = ("bin", "zone_id", "service_type")


def collect(spark, hourly, path):
    query = (
        hourly.writeStream.outputMode("append").format("parquet").option("path", f"{path}/rows")
        .option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(hourly.schema).parquet(f"{path}/rows")


def daily_files(spark, sf_dir, folder):
    """One file per day, written in order."""
    events = tables.table(spark, sf_dir, "events")
    for day in range(1, 31):
        start = datetime(2024, 1, day)
        one = events.where((F.col("ts") >= F.lit(str(start)).cast("timestamp_ntz"))
                           & (F.col("ts") < F.lit(str(start + timedelta(days=1))).cast("timestamp_ntz")))
        one.coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch_on_closed_hours_and_drops_late_trips(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "events")
    daily_files(spark, sf_dir, folder)
    got = rows(collect(spark, stream_hourly(stream_of(spark, folder, maxFilesPerTrigger=1)), tmp_path), *KEYS, "trip_count")
    batch = tables.trips(spark, sf_dir)
    last = batch.agg(F.max("pickup_datetime")).first()[0] - timedelta(hours=2)
    closed = trip_counts(batch).where(F.col("bin") <= F.lit(str(last - timedelta(hours=1))).cast("timestamp_ntz"))
    assert got == rows(closed, *KEYS, "trip_count") and len(got) > 700

    late = tables.table(spark, sf_dir, "events").limit(1).withColumn(
        "ts", F.lit(str(last - timedelta(days=10))).cast("timestamp_ntz")
    )
    late.withColumns({"event_id": F.lit(31), "value": F.lit(50.0)}).write.mode("append").parquet(folder)
    again = rows(collect(spark, stream_hourly(stream_of(spark, folder, maxFilesPerTrigger=1)), tmp_path), *KEYS, "trip_count")
    assert again == got


def test_micro_batches_are_upserted(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    schema = "bin timestamp_ntz, zone_id int, v int"
    for value, day in ((1, 1), (2, 1), (3, 2)):
        made = spark.createDataFrame([(datetime(2024, 1, day), 1, value)], schema)
        made.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        keyed = with_months(stream.withColumn("bin_str", hour_text(F.col("bin"))))
        write_keyed(keyed, table, checkpoint=str(tmp_path / "state")).awaitTermination()
    assert rows(read_table(spark, table), "v") == [(2,), (3,)]


def test_a_new_checkpoint_is_a_new_stream(spark, tmp_path):
    table, schema = str(tmp_path / "table"), "bin timestamp_ntz, zone_id int, v int"
    for value in (1, 2):
        source = str(tmp_path / f"in{value}")
        spark.createDataFrame([(datetime(2024, 1, 1), value, value)], schema).write.parquet(source)
        keyed = with_months(spark.readStream.schema(schema).parquet(source).withColumn("bin_str", hour_text(F.col("bin"))))
        write_keyed(keyed, table, checkpoint=str(tmp_path / f"state{value}")).awaitTermination()
    assert rows(read_table(spark, table), "v") == [(1,), (2,)]
    assert set(newest(spark, table).batches) == {str(tmp_path / "state1"), str(tmp_path / "state2")}
