"""Column profile and type narrowing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole-number types from narrow to wide with their greatest value.
WHOLE_TYPES = (("tinyint", 127), ("smallint", 32767), ("int", 2147483647))
FLOAT_MAX = 3.4028234663852886e38
# Fixed value: how far a narrowed number may lie from the number itself.
FLOAT_TOLERANCE = 5e-4
CATEGORY_SHARE = 0.5


def _narrowest(kind: T.DataType) -> Column:
    low, high = F.col("min_value"), F.col("max_value")
    if isinstance(kind, T.IntegralType):
        choice = F.when(low.isNull(), F.lit(kind.simpleString()))
        for name, limit in WHOLE_TYPES:
            choice = choice.when((low >= -limit - 1) & (high <= limit), F.lit(name))
        return choice.otherwise(F.lit("bigint"))
    fits = (F.greatest(F.abs(low), F.abs(high)) <= FLOAT_MAX) & (F.col("float_error") <= FLOAT_TOLERANCE)
    return F.when(fits, F.lit("float")).otherwise(F.lit(kind.simpleString()))


def _float_error(field: T.StructField) -> Column:
    """How far a number moves when it is kept as float; whole numbers are never kept so."""
    value = F.col(f"`{field.name}`").cast("double")
    error = F.abs(value - value.cast("float").cast("double"))
    return F.lit(None).cast("double") if isinstance(field.dataType, T.IntegralType) else F.coalesce(error, F.lit(0.0))


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per numeric or string column with its range, counts and the type it can be kept in.

    Numbers are measured in one aggregate. Distinct texts are counted exactly by grouping on
    (column, text), which combines repeats before the shuffle. A text column is a category when
    fewer than half of its values differ.
    """
    numbers = [f for f in df.schema if isinstance(f.dataType, (T.IntegralType, T.FractionalType))]
    texts = [f for f in df.schema if isinstance(f.dataType, T.StringType)]
    parts = []
    if numbers:
        stats = df.agg(
            *[
                F.struct(
                    F.min(f.name).cast("double").alias("min_value"),
                    F.max(f.name).cast("double").alias("max_value"),
                    F.count(F.lit(1)).alias("row_count"),
                    F.max(_float_error(f)).alias("float_error"),
                ).alias(f.name)
                for f in numbers
            ]
        )
        rows = F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    *[F.col(f"`{f.name}`.{s}").alias(s) for s in ("min_value", "max_value", "row_count", "float_error")],
                )
                for f in numbers
            ]
        )
        kinds = F.when(F.lit(False), F.lit(None).cast("string"))
        for f in numbers:
            kinds = kinds.when(F.col("column_name") == f.name, _narrowest(f.dataType))
        parts.append(
            stats.select(F.inline(rows)).withColumns(
                {"distinct_count": F.lit(None).cast("bigint"), "narrow_type": kinds}
            )
        )
    if texts:
        pairs = df.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("text"))
                        for f in texts
                    ]
                )
            ).alias("_pair")
        ).select("_pair.*")
        repeats = pairs.groupBy("column_name", "text").agg(F.count(F.lit(1)).alias("_repeats"))
        share = F.col("distinct_count") / F.col("row_count")
        parts.append(
            repeats.groupBy("column_name")
            .agg(
                F.sum("_repeats").alias("row_count"),
                F.count(F.lit(1)).alias("distinct_count"),
            )
            .withColumns(
                {
                    "min_value": F.lit(None).cast("double"),
                    "max_value": F.lit(None).cast("double"),
                    "narrow_type": F.when(share < CATEGORY_SHARE, F.lit("category")).otherwise(
                        F.lit("string")
                    ),
                }
            )
        )
    names = ("column_name", "row_count", "min_value", "max_value", "distinct_count", "narrow_type")
    result = parts[0].select(*names)
    return result.unionByName(parts[1].select(*names)) if len(parts) > 1 else result


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast each numeric column to the type its profile names; the profile has one row per column."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, (T.IntegralType, T.FractionalType))]
    if not numeric:
        return df
    profile = profile_columns(df.select(*numeric)).select("column_name", "narrow_type")
    casts = {row["column_name"]: row["narrow_type"] for row in profile.collect()}
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in casts.items()})
