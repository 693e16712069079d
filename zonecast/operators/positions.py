"""Row positions per zone in time order, without one sorted group per zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.schemas import BIN, ZONE


def total_order(df: DataFrame, ties: Sequence[str] | None, zone: str = ZONE, bin: str = BIN) -> list[str]:
    """Columns that order the rows of one zone and hour: ``ties``, or all others that can be ordered."""
    if ties is not None:
        return list(ties)
    return [f.name for f in df.schema if f.name not in (zone, bin) and not isinstance(f.dataType, (T.MapType, T.VariantType))]


def zone_positions(
    df: DataFrame, zone: str = ZONE, bin: str = BIN, ties: Sequence[str] | None = None
) -> DataFrame:
    """Add ``_rn`` (position from 1) and ``_n`` (rows of the zone).

    Rows are numbered within (zone, month) and shifted by the size of the zone's earlier months, so
    a zone with a large share of all rows is spread over its months. Rows of one hour stand in the
    order of ``ties``, of all other columns without.
    """
    month = F.trunc(bin, "MM")
    sizes = df.groupBy(F.col(zone), month.alias("_month")).agg(F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy(zone)
    earlier = whole.orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        zone,
        "_month",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(whole).alias("_n"),
    )
    within = Window.partitionBy(zone, "_month").orderBy(bin, *total_order(df, ties, zone, bin))
    return (
        df.withColumn("_month", month)
        .join(offsets, [zone, "_month"])
        .withColumn("_rn", F.row_number().over(within) + F.col("_before"))
        .drop("_month", "_before")
    )


def chronological_split(
    df: DataFrame, train: float = 0.7, val: float = 0.85, zone: str = ZONE, bin: str = BIN, ties: Sequence[str] | None = None
) -> DataFrame:
    """Tag each zone's first rows ``train``, the next ``val`` and the rest ``test``, in time order.

    Give ``ties=()`` where a zone has one row an hour at most, as in the dense panel: rows are then
    sorted by the hour alone.
    """
    upto = lambda share: F.floor(F.col("_n").cast("double") * F.lit(float(share)))
    split = (
        F.when(F.col("_rn") <= upto(train), "train")
        .when(F.col("_rn") <= upto(val), "val")
        .otherwise("test")
    )
    return zone_positions(df, zone, bin, ties).withColumn("split", split).drop("_rn", "_n")
