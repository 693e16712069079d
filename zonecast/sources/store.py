"""Keyed Parquet tables: the feature panel, the prediction log, monthly slices and artifacts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.times import Moment, hour_text, naive
from zonecast.operators.keyed import latest_per_key
from zonecast.schemas import BIN, DAY, HOURLY_WEATHER, PANEL, PREDICTION_TYPES, ZONE
from zonecast.session import small, stage, tasks, tasks_for
from zonecast.sources.versions import add_folders, commit, newest, next_version, read_version, replace_folders

MONTHS = ("pickup_year", "pickup_month")
KEYS = (ZONE, "bin_str")
MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` with all its columns, or None where there is none yet.

    A keyed table is read by its newest manifest, as it stands now: later writes do not change what
    the result returns. A folder without one was written otherwise; its columns are merged from its
    files.
    """
    manifest = newest(spark, path)
    if manifest is not None:
        return read_version(spark, path, manifest)
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() in MISSING:
            return None
        raise


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a keyed table, or the rows of a folder that was written otherwise."""
    found = _existing(spark, path)
    return spark.read.parquet(path) if found is None else found


def _write_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Overwrite just the partitions present in ``df``; large ones are split over several tasks."""
    df.hint("rebalance", *[F.col(name) for name in partitions]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partitions).parquet(path)


def _in_partitions(stored: DataFrame, touched: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Stored rows of the touched partitions, those without a value included.

    The least and greatest touched value of each partition column, one row for any number of
    folders, prunes the scan; the null-safe semi join is exact.
    """
    ends = touched.agg(
        *[
            F.struct(
                F.min(name).alias("low"), F.max(name).alias("high"), F.bool_or(F.col(name).isNull()).alias("missing")
            ).alias(name)
            for name in partitions
        ]
    ).first()
    for name in partitions:
        inside = F.col(name).between(F.lit(ends[name]["low"]), F.lit(ends[name]["high"]))
        stored = stored.where(inside | F.col(name).isNull() if ends[name]["missing"] else inside)
    return stored.alias("s").join(touched.alias("t"), _same("s", "t", partitions), "left_semi")


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    """Equality of columns under two aliases; a null equals a null."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


def upsert_features(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = KEYS,
    order_by: Sequence[str] = (),
    partitions: Sequence[str] = MONTHS,
) -> DataFrame:
    """Merge ``df`` into the table at ``path``; per key a new row replaces the stored one.

    Several new rows of one key are decided by ``order_by``, greatest first (by all columns
    without one). Only the partitions that ``df`` touches are read and rewritten; a small batch is
    broadcast against them, so stored rows are not shuffled for it. The rows of both are counted, so
    that tasks grow in number and not in size. The merged rows go to folders of
    their own, which the next version of the table names: readers see the old version until then, a
    lost executor or driver costs no data, and of two writers at once the second fails. A null
    partition value or key is a value like any other. Returns the table.
    """
    spark = df.sparkSession
    before = newest(spark, path)
    stored = _existing(spark, path)
    given = stage(df, "upsert_given")
    many = given.count()
    if stored is not None:
        with tasks(spark, tasks_for(spark, many)):
            rows = stage(latest_per_key(given, keys, order_by), "upsert_new")
        touched = rows.select(*partitions).distinct() if before is not None else stored.select(*partitions).distinct()
        old = _in_partitions(stored, touched, partitions)
        many = rows.count() + old.count()
    with tasks(spark, tasks_for(spark, many)):
        if stored is None:
            rows = latest_per_key(given, keys, order_by)
        else:
            kept = old.alias("o").join(small(rows.select(*keys), "upsert_keys").alias("n"), _same("o", "n", keys), "left_anti")
            rows = stage(kept.unionByName(rows, allowMissingColumns=True), "upsert_rows")
        after = next_version(before, rows.schema, keys, partitions)
        commit(spark, path, replace_folders(path, after, rows))
    return _existing(spark, path)


def append_delta(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = KEYS,
    order_by: Sequence[str] = (),
    partitions: Sequence[str] = MONTHS,
    source: str | None = None,
    batch: int | None = None,
) -> DataFrame:
    """Merge ``df`` into the table at ``path`` without reading it; per key a new row replaces the old one.

    The rows are written over those of their partitions and merged on reading, so a write costs by
    its own rows; :func:`zonecast.sources.versions.compact` makes one folder of several again. A
    batch number of ``source`` that the table has taken in already changes nothing.
    """
    spark = df.sparkSession
    before = newest(spark, path)
    if before is not None and source is not None and batch is not None and batch <= before.batches.get(source, -1):
        return read_version(spark, path, before)
    after = next_version(before, df.schema, keys, partitions)
    if source is not None and batch is not None:
        after.batches[source] = batch
    commit(spark, path, add_folders(path, after, latest_per_key(df, keys, order_by)))
    return _existing(spark, path)


def with_months(df: DataFrame, bin: str = BIN) -> DataFrame:
    return df.withColumns({"pickup_year": F.year(bin), "pickup_month": F.month(bin)})


def _months_between(start: Moment | None, end: Moment | None) -> Column | None:
    """Predicate on the month partitions only, so that it prunes folders."""
    month = F.col("pickup_year") * 100 + F.col("pickup_month")
    number = lambda moment: F.year(naive(moment)) * 100 + F.month(naive(moment))
    parts = []
    if start is not None:
        parts.append(month >= number(start))
    if end is not None:
        parts.append(month <= number(end))
    return None if not parts else parts[0] if len(parts) == 1 else parts[0] & parts[1]


def _days_between(start: Moment | None, end: Moment | None) -> Column:
    after = F.lit(True) if start is None else F.col(DAY) >= F.to_date(naive(start))
    before = F.lit(True) if end is None else F.col(DAY) <= F.to_date(naive(end))
    return after & before


def read_features(
    spark: SparkSession,
    path: str,
    cols: Sequence[str],
    start: Moment | None = None,
    end: Moment | None = None,
    closed: str = "both",
    prefix: str | None = None,
) -> DataFrame:
    """Columns of the rows from ``start`` to ``end``; ``closed='left'`` leaves ``end`` out.

    Columns added later are null in rows stored before. ``prefix`` is stripped from column names. Where the table is partitioned by month or by day,
    folders outside the range are not read.
    """
    if closed not in ("both", "left"):
        raise ValueError(f"unknown interval: {closed}")
    table = read_table(spark, path)
    if prefix:
        table = table.withColumnsRenamed(
            {name: name.removeprefix(prefix) for name in table.columns if name.startswith(prefix)}
        )
    months = _months_between(start, end)
    if months is not None and set(MONTHS) <= set(table.columns):
        table = table.where(months)
    if DAY in table.columns:
        table = table.where(_days_between(start, end))
    if start is not None:
        table = table.where(F.col(BIN) >= naive(start))
    if end is not None:
        last = F.col(BIN) <= naive(end) if closed == "both" else F.col(BIN) < naive(end)
        table = table.where(last)
    return table.select(*cols)


def prediction_schema(df: DataFrame, types: Mapping[str, str] = PREDICTION_TYPES) -> DataFrame:
    """Cast to the prediction log's types, add ``bin_str`` and drop leftover index columns."""
    casts = {name: F.col(name).cast(kind) for name, kind in types.items() if name in df.columns}
    return df.drop("level_0", "index").withColumns(casts).withColumn(
        "bin_str", hour_text(F.col(BIN))
    )


def append_predictions(pred: DataFrame, hist: DataFrame, path: str) -> DataFrame:
    """Upsert forecasts into the log, partitioned by day; the first run also writes the history.

    A forecast replaces history, and a later forecast an earlier one.
    """
    spark = pred.sparkSession
    if _existing(spark, path) is not None:
        return upsert_features(pred.withColumn(DAY, F.to_date(BIN)), path, partitions=(DAY,))
    both = pred.withColumn("_rank", F.lit(1)).unionByName(
        hist.withColumn("_rank", F.lit(0)), allowMissingColumns=True
    )
    both = stage(both, "log_rows")
    with tasks(spark, tasks_for(spark, both.count())):
        rows = latest_per_key(both, KEYS, ["_rank"]).drop("_rank")
        return upsert_features(rows.withColumn(DAY, F.to_date(BIN)), path, partitions=(DAY,))


def backfill_months(
    trips: DataFrame, start: Moment, end: Moment, path: str, ts: str = "pickup_datetime"
) -> DataFrame:
    """Write the trips of every month from ``start``'s to ``end``'s, one folder per month.

    One range filter and one partitioned write cover all months. Returns the written table.
    """
    first = F.trunc(naive(start), "MM").cast("timestamp_ntz")
    after = F.add_months(F.trunc(naive(end), "MM"), 1).cast("timestamp_ntz")
    kept = trips.where((F.col(ts) >= first) & (F.col(ts) < after))
    months = kept.withColumns({"year": F.year(ts), "month": F.month(ts)})
    _write_partitions(months, path, ("year", "month"))
    return trips.sparkSession.read.parquet(path)


def save_panel(panel: DataFrame, path: str) -> None:
    panel.write.mode("overwrite").parquet(path)


def save_artifacts(panel: DataFrame, weather: DataFrame, folder: str) -> None:
    """Panel as Parquet, weather as CSV with a header."""
    save_panel(panel, f"{folder}/panel")
    weather.write.mode("overwrite").csv(f"{folder}/weather", header=True)


def load_artifacts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    panel = spark.read.schema(PANEL).parquet(f"{folder}/panel")
    weather = spark.read.schema(HOURLY_WEATHER).csv(f"{folder}/weather", header=True)
    return panel, weather
