"""One row per key, chosen by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest: bool) -> DataFrame:
    # A rank of one is a group limit: every task keeps its best row per key before the shuffle.
    order = [F.col(name).desc() if latest else F.col(name).asc() for name in (order_by or df.columns)]
    ranked = df.withColumn("_turn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_turn") == 1).drop("_turn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` (all columns without one) per key.

    Nulls are least. Map tasks keep one row per key, so copies of a hot key never meet in one task.
    """
    return _pick(df, keys, order_by, latest=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the least ``order_by`` per key."""
    return _pick(df, keys, order_by, latest=False)
