"""City sums, lags and history/candidate stacking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions.times import hour_number
from zonecast.operators.keyed import first_per_key
from zonecast.operators.positions import total_order, zone_positions
from zonecast.schemas import BIN, CITY_DEMAND, LAG_SOURCES, LAGS, NEIGHBOR_DEMAND, TARGETS, ZONE
from zonecast.session import small


def city_sums(df: DataFrame, targets: Sequence[str] = TARGETS, bin: str = BIN) -> DataFrame:
    return df.groupBy(bin).agg(*[F.sum(t).alias(f"{t}_city_hour_pickups") for t in targets])


def city_demand(panel: DataFrame, targets: Sequence[str] = TARGETS, bin: str = BIN) -> DataFrame:
    """Add the city's pickups of the hour per service: one aggregate, one join on the hour."""
    return panel.join(small(city_sums(panel, targets, bin), "city_sums"), bin, "left")


def _lag_columns(cols: Sequence[str], lags: Sequence[int], take) -> dict[str, Column]:
    return {
        f"{name}_lag_{lag}h": F.coalesce(take(name, lag), F.lit(0)) for name in cols for lag in lags
    }


def lag_features(
    panel: DataFrame,
    cols: Sequence[str] = LAG_SOURCES,
    lags: Sequence[int] = LAGS,
    mode: str = "rows",
    carry_in: DataFrame | None = None,
    block_rows: int | None = None,
    zone: str = ZONE,
    bin: str = BIN,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``{col}_lag_{k}h`` per zone in time order, 0 where there is no earlier row.

    ``mode='rows'`` counts rows, ``mode='time'`` counts hours. ``carry_in`` holds earlier rows that
    feed the first lags and are not returned. All lags share one window. A zone holds one row per
    hour, which bounds the size of a window group; for few zones with very long histories
    ``block_rows`` cuts each zone into blocks of that many rows, each with the rows it looks back to.
    Rows of one zone and hour stand in the order of the columns ``ties`` (of all others without),
    so the result does not depend on the order of the input.
    """
    if mode not in ("rows", "time"):
        raise ValueError(f"unknown lag mode: {mode}")
    source = panel
    if carry_in is not None:
        source = panel.withColumn("_kept", F.lit(True)).unionByName(
            carry_in.withColumn("_kept", F.lit(False)), allowMissingColumns=True
        )
    if mode == "time":
        order = Window.partitionBy(zone).orderBy(hour_number(F.col(bin)))
        take = lambda name, lag: F.max(name).over(order.rangeBetween(-lag, -lag))
        result = source.withColumns(_lag_columns(cols, lags, take))
    elif block_rows is None:
        order = Window.partitionBy(zone).orderBy(bin, *total_order(source, ties, zone, bin))
        take = lambda name, lag: F.lag(name, lag).over(order)
        result = source.withColumns(_lag_columns(cols, lags, take))
    else:
        result = _lags_in_blocks(source, cols, lags, block_rows, zone, bin, ties)
    if carry_in is not None:
        result = result.where("_kept").drop("_kept")
    return result


def _lags_in_blocks(
    source: DataFrame, cols: Sequence[str], lags: Sequence[int], block_rows: int, zone: str, bin: str,
    ties: Sequence[str] | None,
) -> DataFrame:
    """Row lags on blocks of consecutive rows; the last rows of a block also go to the next one."""
    reach = max(lags)
    if block_rows < reach:
        raise ValueError("block_rows must cover the longest lag")
    placed = zone_positions(source, zone, bin, ties).drop("_n")
    block = F.floor((F.col("_rn") - 1) / F.lit(block_rows))
    last = block == F.floor((F.col("_rn") - 1 + reach) / F.lit(block_rows))
    homes = F.when(last, F.array(block)).otherwise(F.array(block, block + 1))
    spread = placed.withColumn("_home", block).withColumn("_block", F.explode(homes))
    order = Window.partitionBy(zone, "_block").orderBy("_rn")
    take = lambda name, lag: F.lag(name, lag).over(order)
    lagged = spread.withColumns(_lag_columns(cols, lags, take))
    return lagged.where(F.col("_home") == F.col("_block")).drop("_home", "_block", "_rn")


def dedup_history(
    history: DataFrame, candidates: DataFrame, zone: str = ZONE, bin: str = BIN, order_by: Sequence[str] = ()
) -> DataFrame:
    """Stack history and candidates; per (hour, zone) the history row stays.

    Several rows of one key within a source are decided by ``order_by``, least first.
    """
    stacked = history.withColumn("_source", F.lit(0)).unionByName(
        candidates.withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    return first_per_key(stacked, [bin, zone], ["_source", *order_by]).drop("_source")


def serving_lags(history: DataFrame, candidates: DataFrame, zone: str = ZONE, bin: str = BIN) -> DataFrame:
    """Lags for scoring: 1 and 24 rows of the targets, 1 row of city and neighbour sums; nulls to 0.

    Only lag columns are zero-filled, as the unfilled frame is the one the lags are merged onto.
    """
    stacked = dedup_history(history, candidates, zone, bin)
    order = Window.partitionBy(zone).orderBy(bin, *total_order(stacked, None, zone, bin))
    take = lambda name, lag: F.lag(name, lag).over(order)
    return stacked.withColumns(
        {
            **_lag_columns(TARGETS, LAGS, take),
            **_lag_columns(CITY_DEMAND + NEIGHBOR_DEMAND, (1,), take),
        }
    )
