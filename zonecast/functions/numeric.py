"""Rounding and null handling on columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Round on the binary value, half to even: scale, ``rint``, unscale."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def round_up_half(value: Column, digits: int = 0) -> Column:
    """Round a non-negative value, halves upwards (display rounding)."""
    scale = F.lit(float(10**digits))
    return F.floor(value * scale + F.lit(0.5)) / scale


def inverse_speed(speed: Column) -> Column:
    """Congestion index of a positive speed, null otherwise."""
    return F.when(speed > 0, F.try_divide(F.lit(1.0), speed))


def zero_filled(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in columns})
