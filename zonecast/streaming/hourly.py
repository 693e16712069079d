"""Hourly aggregates from a trip stream, and keyed writes of its micro-batches."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonecast.functions.numeric import inverse_speed
from zonecast.schemas import BIN, ZONE
from zonecast.sources.store import KEYS, MONTHS, append_delta
from zonecast.sources.versions import compact


def stream_hourly(
    stream: DataFrame, watermark: str = "2 hours", ts: str = "pickup_datetime", zone: str = "pulocationid"
) -> DataFrame:
    """Trips, speed sum and mean speed per hour, zone and service of a stream of valid trips.

    Hours close once the watermark has passed them; later trips of a closed hour are dropped.
    Event time must be ``TIMESTAMP`` for a watermark, and is turned back into a naive hour.
    """
    timed = stream.withColumn("_event_time", F.col(ts).cast("timestamp"))
    hourly = (
        timed.withWatermark("_event_time", watermark)
        .groupBy(
            F.window("_event_time", "1 hour"), F.col(zone).alias(ZONE), F.col("service_type")
        )
        .agg(F.count(F.lit(1)).alias("trip_count"), F.sum("mph").alias("mph_sum"))
    )
    mean = F.try_divide(F.col("mph_sum"), F.col("trip_count"))
    return hourly.select(
        F.col("window.start").cast("timestamp_ntz").alias(BIN),
        ZONE,
        "service_type",
        "trip_count",
        mean.alias("avg_speed"),
        inverse_speed(mean).alias("congestion_index"),
    )


def write_keyed(
    stream: DataFrame,
    path: str,
    keys: Sequence[str] = KEYS,
    checkpoint: str | None = None,
    partitions: Sequence[str] = MONTHS,
    available_now: bool = True,
    source: str | None = None,
    folders: int = 16,
) -> StreamingQuery:
    """Start a query that merges each micro-batch by key; ``read_table`` reads the result.

    A batch is written over the stored rows and merged on reading, so what it writes is bound by its
    own rows. Its number is recorded with the version under ``source``: a repeated batch changes
    nothing. Partitions that more than ``folders`` batches have touched are compacted. Batch numbers
    belong to a checkpoint, so ``source`` is the checkpoint's folder unless given; a stream without
    one counts as new each time it starts.
    """
    source = source or checkpoint or uuid.uuid4().hex

    def write(batch: DataFrame, number: int) -> None:
        append_delta(batch, path, keys, partitions=partitions, source=source, batch=number)
        compact(batch.sparkSession, path, folders)

    writer = stream.writeStream.outputMode("append").foreachBatch(write)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
