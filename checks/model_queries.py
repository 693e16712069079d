"""Split, metrics, models and the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables
from checks.expressions import TARGETS, rounded
from checks.registry import query
from zonecast.operators import metrics, ml, trees
from zonecast.operators.lags import lag_features
from zonecast.operators.ml import load_models, predict
from zonecast.operators.panel import hourly_targets
from zonecast.operators.positions import chronological_split
from zonecast.operators.trips import normalize_feed, union_feeds, valid_trips
from zonecast.plans.features import feature_panel
from zonecast.plans.training import split_matrix, train_and_report
from zonecast.schemas import BIN, DAY, FEATURES, FEEDS, ZONE
from zonecast.session import new_stage_path, stage
from zonecast.sources.store import append_delta, read_table
from zonecast.sources.versions import compact
from zonecast.streaming.hourly import stream_hourly, write_keyed

PAIRS = {t: f"{t}_lag_24h" for t in TARGETS}


@query(
    "chronological_split",
    f"""SELECT bin, zone_id, {', '.join(TARGETS)}, CASE WHEN rn <= floor(n * 0.7::DOUBLE) THEN 'train'
        WHEN rn <= floor(n * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY bin) AS rn,
        count(*) OVER (PARTITION BY zone_id) AS n FROM panel)""",
)
def split(spark: SparkSession, sf: str) -> DataFrame:
    return chronological_split(stage(hourly_targets(tables.trips(spark, sf)), "targets"), ties=())


def _metric_rows() -> str:
    one = "SELECT '{t}' AS target, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, 1 - sum(e * e) / nullif(count(*) * var_pop(y), 0) AS r2 FROM (SELECT {t} AS y, {t} - {t}_lag_24h AS e FROM lagged)"
    return " UNION ALL ".join(one.format(t=t) for t in TARGETS)


_ROUNDED = ", ".join(rounded(m, m) for m in ("rmse", "mae", "r2"))


@query(
    "forecast_metrics",
    f"""SELECT target, {_ROUNDED} FROM (SELECT * FROM ({_metric_rows()})
        UNION ALL SELECT 'overall', avg(rmse), avg(mae), avg(r2) FROM ({_metric_rows()}))""",
)
def quality(spark: SparkSession, sf: str) -> DataFrame:
    naive_forecast = lag_features(hourly_targets(tables.trips(spark, sf)), TARGETS)
    return tables.rounded(metrics.forecast_metrics(naive_forecast, PAIRS), "rmse", "mae", "r2")


@query(
    "joint_rmse",
    f"""SELECT {rounded('sqrt((' + ' + '.join(f'avg(({t} - {t}_lag_24h) * ({t} - {t}_lag_24h))' for t in TARGETS) + ') / 3)', 'joint_rmse')}
        FROM lagged""",
)
def joint(spark: SparkSession, sf: str) -> DataFrame:
    naive_forecast = lag_features(hourly_targets(tables.trips(spark, sf)), TARGETS)
    return tables.rounded(metrics.joint_rmse(naive_forecast, PAIRS), "joint_rmse")


_REPORT = " UNION ALL ".join(
    f"SELECT 'lag_{k}h' AS model, (" + " + ".join(f"sqrt(avg(({t} - {t}_lag_{k}h) * ({t} - {t}_lag_{k}h)))" for t in TARGETS) + ") / 3 AS rmse FROM lagged"
    for k in (1, 24)
)


@query("best_model", f"SELECT model, {rounded('rmse', 'rmse')} FROM ({_REPORT}) ORDER BY rmse, model LIMIT 1")
def best(spark: SparkSession, sf: str) -> DataFrame:
    rows = lag_features(hourly_targets(tables.trips(spark, sf)), TARGETS)
    scores = [
        metrics.forecast_metrics(rows, {t: f"{t}_lag_{k}h" for t in TARGETS})
        .where("target = 'overall'")
        .select(F.lit(f"lag_{k}h").alias("model"), "rmse")
        for k in (1, 24)
    ]
    return tables.rounded(metrics.best_model(scores[0].unionByName(scores[1])), "rmse")


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return feature_panel(
        tables.trips(spark, sf),
        tables.hourly_weather(spark, sf),
        tables.edges(spark, sf),
    )


@query("feature_matrix", f"SELECT {', '.join(FEATURES)}, {', '.join(TARGETS)} FROM full_panel")
def matrix(spark: SparkSession, sf: str) -> DataFrame:
    return ml.feature_matrix(_features(spark, sf))


def _split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = stage(split_matrix(stage(_features(spark, sf), "panel")), "matrix")
    return rows.where("split = 'train'"), rows.where("split = 'val'")


@query("train_gbt")
def trained(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts of the validation rows, one regressor per target."""
    train, val = _split(spark, sf)
    models = ml.train_gbt(train)
    return ml.predict(val, models).select(ZONE, *TARGETS, *[f"pred_{t}" for t in TARGETS])


@query("train_forest_one_hot")
def forest(spark: SparkSession, sf: str) -> DataFrame:
    train, val = _split(spark, sf)
    models = ml.train_gbt(train, model="random_forest")
    return ml.predict(val, models).select(ZONE, *TARGETS, *[f"pred_{t}" for t in TARGETS])


@query("score_gbt")
def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned forecasts of all rows after the training share."""
    rows = stage(split_matrix(stage(_features(spark, sf), "panel")), "matrix")
    models = ml.train_gbt(rows.where("split = 'train'"))
    return ml.score_gbt(rows.where("split <> 'train'"), models).select("split", ZONE, *TARGETS)


def _ensemble(spark: SparkSession) -> DataFrame:
    """Two trees a target: on the last hour and the clock, and on the day before."""
    leaf = (None, None, None, None, None)
    made = [
        row for k, t in enumerate(TARGETS) for row in (
            (t, 0, 1.0, 0, 1, 0.5, None, 1, 2, 0.0), (t, 0, 1.0, 1, *leaf, 0.25 + k),
            (t, 0, 1.0, 2, 0, None, [7.0, 8.0, 17.0, 18.0], 3, 4, 0.0), (t, 0, 1.0, 3, *leaf, 3.0), (t, 0, 1.0, 4, *leaf, 1.5),
            (t, 1, 0.5, 0, 2, 1.0, None, 1, 2, 0.0), (t, 1, 0.5, 1, *leaf, -0.5), (t, 1, 0.5, 2, *leaf, 1.0 + k),
        )
    ]
    return spark.createDataFrame(made, trees.NODES)


_BY_TREES = ", ".join(
    f"""CASE WHEN {t}_lag_1h <= 0.5 THEN {0.25 + k} WHEN hour(bin) IN (7, 8, 17, 18) THEN 3.0 ELSE 1.5 END
        + 0.5 * CASE WHEN {t}_lag_24h <= 1 THEN -0.5 ELSE {1.0 + k} END::DOUBLE AS pred_{t}"""
    for k, t in enumerate(TARGETS)
)


@query("score_trees", f"SELECT bin, zone_id, {_BY_TREES} FROM lagged")
def by_trees(spark: SparkSession, sf: str) -> DataFrame:
    """A stored ensemble over the last hour, the clock and the day before of each target."""
    rows, nodes = lag_features(hourly_targets(tables.trips(spark, sf)), TARGETS), stage(_ensemble(spark), "ensemble")
    for t in TARGETS:
        inputs = F.array(F.hour(BIN).cast("double"), *[F.col(f"{t}_lag_{k}h").cast("double") for k in (1, 24)])
        rows = trees.score_trees(rows, nodes, inputs, (t,))
    return rows.select(BIN, ZONE, *[f"pred_{t}" for t in TARGETS])


_VAL = "FILTER (rn > floor(n * 0.7::DOUBLE) AND rn <= floor(n * 0.85::DOUBLE))"
_SPLIT_SIZES = f"""SELECT count(*) FILTER (rn <= floor(n * 0.7::DOUBLE)) AS n_train, count(*) {_VAL} AS n_val,
        ({' + '.join(f'sqrt(avg(({t} - {t}_lag_24h) * ({t} - {t}_lag_24h)) {_VAL})' for t in TARGETS)}) / 3 AS lag_rmse
        FROM (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY bin) AS rn, count(*) OVER (PARTITION BY zone_id) AS n FROM lagged)"""


@query(
    "saved_models",
    f"""SELECT model, CAST(n_train AS BIGINT) AS n_train, CAST(n_val AS BIGINT) AS n_val, {rounded('lag_rmse', 'lag_rmse')}, TRUE AS equal, TRUE AS reported
        FROM ({_SPLIT_SIZES}), (VALUES ('gbt'), ('random_forest')) AS names(model)""",
)
def saved(spark: SparkSession, sf: str) -> DataFrame:
    """Both default models fitted, reported, saved and loaded.

    Whether its loaded copy and the table of its nodes forecast what the fitted one did, whether the
    report holds the errors of these forecasts, and the error of the day before for comparison.
    """
    folder, panel = new_stage_path(spark, "models"), stage(_features(spark, sf), "panel")
    models, found = train_and_report(panel, {"gbt": {}, "random_forest": {}}, folder)
    rows = stage(split_matrix(panel), "matrix")
    val = rows.where("split = 'val'").withColumn("_row", F.monotonically_increasing_id())
    val = stage(val, "val")
    naive = metrics.forecast_metrics(val, PAIRS).where("target = 'overall'").select(F.col("rmse").alias("naive"))
    results = []
    for name, fitted in models.items():
        loaded = load_models(spark, folder, name)
        own = predict(val, fitted).select("_row", *TARGETS, *[F.col(f"pred_{t}").alias(f"own_{t}") for t in TARGETS])
        again = predict(val, loaded).select("_row", *[f"pred_{t}" for t in TARGETS])
        stored = trees.predict_by_table(val, loaded[TARGETS[0]].stages[0], trees.tree_nodes(loaded), TARGETS)
        stored = stored.select("_row", *[F.col(f"pred_{t}").alias(f"stored_{t}") for t in TARGETS])
        same = [
            (F.col(f"own_{t}") == F.col(f"pred_{t}")) & (F.abs(F.col(f"own_{t}") - F.col(f"stored_{t}")) < 1e-9) for t in TARGETS
        ]
        results.append(own.join(again, "_row").join(stored, "_row").agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_val"), F.bool_and(same[0] & same[1] & same[2]).alias("equal"),
            (sum(F.sqrt(F.avg((F.col(t) - F.col(f"stored_{t}")) ** 2)) for t in TARGETS) / 3).alias("own_rmse"),
        ))
    sizes = rows.agg(F.count_if(F.col("split") == "train").alias("n_train")).scalar()
    reported = (F.abs(F.col("rmse") - F.col("own_rmse")) < 1e-9).alias("reported")
    shown = results[0].unionByName(results[1]).join(found, "model").select(
        "model", sizes.alias("n_train"), "n_val", naive.scalar().alias("lag_rmse"), "equal", reported
    )
    return tables.rounded(shown, "lag_rmse")


@query("tune_report")
def tuned(spark: SparkSession, sf: str) -> DataFrame:
    train, val = _split(spark, sf)
    return ml.tune_report(train, val)


@query("model_report")
def report(spark: SparkSession, sf: str) -> DataFrame:
    return train_and_report(stage(_features(spark, sf), "panel"), {"gbt": {}, "random_forest": {}})[1]


def stream_of(spark: SparkSession, folder: str, pattern: str = "*.parquet", **options) -> DataFrame:
    """Valid trips of the events files of a folder, as one stream."""
    feeds = []
    for feed in FEEDS:
        events = (
            spark.readStream.schema("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double")
            .options(pathGlobFilter=pattern, **options)
            .parquet(folder)
        )
        feeds.append(normalize_feed(tables.feed_of(events, feed), feed))
    return valid_trips(union_feeds(*feeds))


@query(
    "stream_hourly",
    f"""SELECT bin, zone_id, service_type, count(*) AS trip_count, {rounded('avg(mph)', 'avg_speed')},
        {rounded('1 / avg(mph)', 'congestion_index')} FROM good_trips
        WHERE bin + INTERVAL 1 HOUR <= (SELECT max(pickup_datetime) FROM good_trips) - INTERVAL 2 HOUR GROUP BY ALL""",
)
def streamed(spark: SparkSession, sf: str) -> DataFrame:
    """Closed hours of a stream over the events file."""
    out = new_stage_path(spark, "stream")
    hourly = stream_hourly(stream_of(spark, sf, "events.parquet"))
    started = (
        hourly.writeStream.outputMode("append").format("parquet")
        .option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state")
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    return tables.rounded(
        spark.read.schema(hourly.schema).parquet(f"{out}/rows"), "avg_speed", "congestion_index"
    )


_KEYED = f"""SELECT bin, zone_id, service_type, count(*) AS trip_count, {rounded('avg(mph)', 'avg_speed')},
        strftime(bin, '%Y-%m-%d') AS bin_date FROM good_trips
        WHERE bin + INTERVAL 1 HOUR <= (SELECT max(pickup_datetime) FROM good_trips) - INTERVAL 2 HOUR GROUP BY ALL"""


def _kept_by_key(spark: SparkSession, sf: str) -> str:
    """A table that a stream has written closed hours to, partitioned by day."""
    out = new_stage_path(spark, "keyed")
    hourly = stream_hourly(stream_of(spark, sf, "events.parquet")).withColumn(DAY, F.to_date(BIN))
    write_keyed(hourly, f"{out}/rows", (BIN, ZONE, "service_type"), f"{out}/state", (DAY,)).awaitTermination()
    return f"{out}/rows"


def _keyed_rows(spark: SparkSession, path: str) -> DataFrame:
    found = read_table(spark, path).drop("congestion_index")
    return tables.rounded(found.withColumn(DAY, F.col(DAY).cast("string")), "avg_speed")


@query("keyed_stream", _KEYED)
def keyed(spark: SparkSession, sf: str) -> DataFrame:
    return _keyed_rows(spark, _kept_by_key(spark, sf))


@query("keyed_stream_compacted", _KEYED)
def keyed_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """The same after every row was written once more as a delta and all folders were compacted."""
    path = _kept_by_key(spark, sf)
    append_delta(read_table(spark, path), path, (BIN, ZONE, "service_type"), partitions=(DAY,))
    compact(spark, path)
    return _keyed_rows(spark, path)
