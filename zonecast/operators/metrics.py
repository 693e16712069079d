"""Forecast quality."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _error(actual: str, forecast: str) -> Column:
    return F.col(actual).cast("double") - F.col(forecast).cast("double")


def _r2(actual: str, forecast: str) -> Column:
    residual = F.sum(_error(actual, forecast) ** 2)
    spread = F.count(actual) * F.var_pop(F.col(actual).cast("double"))
    constant = F.when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(spread > 0, F.lit(1.0) - F.try_divide(residual, spread)).otherwise(constant)


def forecast_metrics(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """RMSE, MAE and R2 per target (``pairs`` maps actual to forecast column) and their means.

    One aggregate over the rows. Constant actuals score 1 where met exactly, else 0.
    """
    scored = df.where(
        " AND ".join(f"`{a}` IS NOT NULL AND `{f}` IS NOT NULL" for a, f in pairs.items())
    )
    one = scored.agg(
        *[
            F.struct(
                F.lit(actual).alias("target"),
                F.sqrt(F.avg(_error(actual, forecast) ** 2)).alias("rmse"),
                F.avg(F.abs(_error(actual, forecast))).alias("mae"),
                _r2(actual, forecast).alias("r2"),
            ).alias(actual)
            for actual, forecast in pairs.items()
        ]
    )
    mean = lambda name: sum([F.col(f"{a}.{name}") for a in pairs], F.lit(0.0)) / F.lit(float(len(pairs)))
    overall = F.struct(
        F.lit("overall").alias("target"), *[mean(m).alias(m) for m in ("rmse", "mae", "r2")]
    )
    return one.select(F.inline(F.array(*[F.col(a) for a in pairs], overall)))


def joint_rmse(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Root of the targets' mean squared errors averaged: the tuning objective."""
    errors = [F.avg(_error(a, f) ** 2) for a, f in pairs.items()]
    return df.agg(F.sqrt(sum(errors, F.lit(0.0)) / F.lit(float(len(errors)))).alias("joint_rmse"))


def best_model(report: DataFrame) -> DataFrame:
    """The report row with the least RMSE; names decide ties."""
    return report.orderBy("rmse", "model").limit(1)
