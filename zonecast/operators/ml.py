"""Feature matrix, multi-target regressors and their search, on Spark MLlib."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from zonecast.operators.forest import fit_forests, inputs_of
from zonecast.operators.metrics import best_model, forecast_metrics, joint_rmse
from zonecast.operators.scoring import clean_forecast
from zonecast.schemas import CATEGORICAL, FEATURES, TARGETS
from zonecast.session import planned_bytes

# Search spaces of the tree models.
SEARCH_SPACES = {
    "gbt": {
        "stepSize": {"type": "float", "low": 0.01, "high": 0.2, "log": True},
        "maxDepth": {"type": "int", "low": 4, "high": 8},
        "minInstancesPerNode": {"type": "int", "low": 20, "high": 100},
        "subsamplingRate": {"type": "float", "low": 0.6, "high": 0.9},
        "featureSubsetStrategy": {"type": "share", "low": 0.6, "high": 1.0},
    },
    "random_forest": {
        "numTrees": {"type": "int", "low": 100, "high": 150},
        "maxDepth": {"type": "int", "low": 5, "high": 20},
        "minInstancesPerNode": {"type": "int", "low": 20, "high": 100},
        "featureSubsetStrategy": {"type": "categorical", "choices": ["sqrt", "log2"]},
    },
}
REGRESSORS = {"gbt": GBTRegressor, "random_forest": RandomForestRegressor}
# Fixed value: models that take categories one-hot encoded.
ONE_HOT = ("random_forest",)
VECTOR = "features"
CONTINUOUS_BINS = 32
PARALLEL_TRIALS = 8
FIT_BYTES = 8 * 1024 * 1024  # of a partition of training rows, as stored
LAID_OUT_BYTES = 1024 * 1024 * 1024  # of the numbers that Spark's trees keep for a target, from which on one-hot columns are not laid out


def feature_matrix(df: DataFrame, features: Sequence[str] = FEATURES, targets: Sequence[str] = TARGETS) -> DataFrame:
    """Model inputs and targets, with ``split`` where the rows carry one; times are dropped."""
    kept = [*features, *targets, *(["split"] if "split" in df.columns else [])]
    return df.select(*kept)


def _number_of(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Trees cannot split on nulls: missing readings become 0."""
    return df.withColumns({name: F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in features})


def bin_edges(numbers: DataFrame, names: Sequence[str], bins: int = CONTINUOUS_BINS) -> list[list[float]]:
    """Cuts of each column into at most ``bins`` bins.

    Half of the cuts are quantiles of the rows and half quantiles of the distinct values, so that a
    column of mostly one value keeps cuts among its rare ones. Values are counted before they are
    ranked; sketches, not values, reach one task per column.
    """
    shares = [k / (bins // 2) for k in range(1, bins // 2)]
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("value")) for name in names]))
    values = numbers.select(pairs.alias("pair")).select("pair.*").groupBy("name", "value").agg(F.count(F.lit(1)).alias("many"))
    distinct = values.groupBy("name").agg(F.percentile_approx("value", shares, 1000).alias("cuts"))
    found = {row["name"]: row["cuts"] for row in distinct.collect()}
    of_rows = numbers.agg(*[F.percentile_approx(name, shares, 1000).alias(name) for name in names]).first()
    inner = [sorted({*(found.get(name) or []), *(of_rows[name] or [])}) for name in names]
    return [[-math.inf, *cuts, math.inf] for cuts in inner]


def feature_stages(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    categorical: Sequence[str] = CATEGORICAL,
    one_hot: bool = False,
) -> tuple[PipelineModel, int]:
    """Fitted feature stages shared by all targets, and the bins a tree needs for the categories.

    Indexes are learned from the training rows and reused at scoring; unseen values get their own.
    The ``categorical`` list alone decides what is a category, at any number of values. A tree's
    setting holds for all features, so the others are cut into ``CONTINUOUS_BINS`` bins first: their histograms keep that size, and every tree of every trial shares the cuts.
    """
    used = [name for name in categorical if name in features]
    kinds = dict(train.dtypes)
    for name in used:
        if kinds[name].startswith(("array", "map", "struct", "binary")):
            raise ValueError(f"column {name} of type {kinds[name]} cannot be used as a category")
    numbers = _number_of(train, features)
    indexed = [f"{name}_index" for name in used]
    stages: list[Any] = []
    if used:
        stages.append(StringIndexer(inputCols=used, outputCols=indexed, handleInvalid="keep"))
    inputs = indexed
    if one_hot and used:
        inputs = [f"{name}_onehot" for name in used]
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=inputs, handleInvalid="keep"))
    plain = [name for name in features if name not in used]
    binned = [f"{name}_bin" for name in plain]
    if plain:
        edges = bin_edges(numbers, plain)
        stages.append(Bucketizer(splitsArray=edges, inputCols=plain, outputCols=binned, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[*binned, *inputs], outputCol=VECTOR))
    fitted = Pipeline(stages=stages).fit(numbers)
    sizes = [
        len(labels)
        for stage in fitted.stages
        if isinstance(stage, StringIndexerModel) and not one_hot
        for labels in stage.labelsArray
    ]
    return fitted, max([32, *[size + 1 for size in sizes]])


def vectors(df: DataFrame, stages: PipelineModel, features: Sequence[str] = FEATURES) -> DataFrame:
    """Rows with their feature vector; the original columns keep their values."""
    raw = df.withColumn("_row", F.struct(*df.columns))
    return stages.transform(_number_of(raw, features)).select("_row.*", VECTOR)


def _regressor(model: str, target: str, params: Mapping[str, Any], bins: int, seed: int) -> Estimator:
    settings = {"maxIter": 20} if model == "gbt" else {}
    settings.update(params)
    return REGRESSORS[model](
        featuresCol=VECTOR, labelCol=target, predictionCol=f"pred_{target}", maxBins=bins, seed=seed,
        **settings,
    )


def _fit_targets(
    rows: DataFrame, targets: Sequence[str], params: Mapping[str, Any], model: str, bins: int, seed: int
) -> dict[str, Any]:
    """One fitted regressor per target; the targets are fitted at the same time."""
    fit = inheritable_thread_target(rows.sparkSession)(lambda t: _regressor(model, t, params, bins, seed).fit(rows))
    with ThreadPoolExecutor(len(targets)) as pool:
        return dict(zip(targets, pool.map(fit, targets), strict=True))


def _model_rows(df: DataFrame, stages: PipelineModel, targets: Sequence[str]) -> DataFrame:
    """Vectors and targets in partitions of at least ``FIT_BYTES``: every level of every tree is a job."""
    parts = max(1, -(-planned_bytes(df) // FIT_BYTES))
    return vectors(df, stages).select(VECTOR, *[F.col(t).cast("double").alias(t) for t in targets]).coalesce(parts)


def train_gbt(
    df: DataFrame,
    targets: Sequence[str] = TARGETS,
    params: Mapping[str, Any] | None = None,
    model: str = "gbt",
    seed: int = 42,
) -> dict[str, PipelineModel]:
    """One fitted regressor per target, all on the same feature stages.

    A forest whose one-hot columns would take ``LAID_OUT_BYTES`` is fitted from the codes of the categories.
    """
    stages, bins = feature_stages(df, one_hot=model in ONE_HOT)
    if model in ONE_HOT and (many := df.count()) * inputs_of(stages).width * 4 > LAID_OUT_BYTES:
        regressors = {t: _regressor(model, t, params or {}, bins, seed) for t in targets}
        fitted = fit_forests(_number_of(df, FEATURES), many, stages, targets, regressors)
        return {t: PipelineModel([stages, m]) for t, m in fitted.items()}
    rows = _model_rows(df, stages, targets).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = _fit_targets(rows, targets, params or {}, model, bins, seed)
    finally:
        rows.unpersist()
    return {t: PipelineModel([stages, m]) for t, m in fitted.items()}


def predict(df: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """Add ``pred_{target}`` for each model; the shared feature stages run once."""
    first = next(iter(models.values()))
    rows = vectors(df, first.stages[0])
    for model in models.values():
        rows = model.stages[1].transform(rows)
    return rows.drop(VECTOR)


def score_gbt(df: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """Forecasts of all targets, cleaned, under the target names."""
    scored = predict(df.drop(*models), models)
    renamed = scored.withColumnsRenamed({f"pred_{t}": t for t in models})
    return clean_forecast(renamed, tuple(models))


def _draw(space: Mapping[str, Mapping[str, Any]], source: random.Random) -> dict[str, Any]:
    """One random point of a search space."""
    point: dict[str, Any] = {}
    for name, rule in space.items():
        if rule["type"] == "categorical":
            point[name] = source.choice(list(rule["choices"]))
        elif rule["type"] == "int":
            point[name] = source.randint(int(rule["low"]), int(rule["high"]))
        elif rule["type"] == "share":
            point[name] = f"{source.uniform(rule['low'], rule['high']):.4f}"
        elif rule.get("log"):
            point[name] = math.exp(source.uniform(math.log(rule["low"]), math.log(rule["high"])))
        else:
            point[name] = source.uniform(float(rule["low"]), float(rule["high"]))
    return point


def _trial_score(
    fit_rows: DataFrame, val_rows: DataFrame, point: Mapping[str, Any], model: str, bins: int, seed: int, targets: Sequence[str]
) -> float:
    scored = val_rows
    for fitted in _fit_targets(fit_rows, targets, point, model, bins, seed).values():
        scored = fitted.transform(scored)
    return joint_rmse(scored, {t: f"pred_{t}" for t in targets}).first()["joint_rmse"]


def tune_report(
    train: DataFrame,
    val: DataFrame,
    spaces: Mapping[str, Mapping[str, Mapping[str, Any]]] = SEARCH_SPACES,
    n_trials: int = 20,
    seed: int = 42,
    targets: Sequence[str] = TARGETS,
    fixed: Mapping[str, Any] | None = None,
    parallel: int = PARALLEL_TRIALS,
) -> DataFrame:
    """Seeded random search per model on a fixed validation set: one row per trial.

    The features are indexed and cut into bins once per model, and the binned vectors of both sets
    are kept across its trials, of which ``parallel`` run at the same time. Points are drawn before
    any trial starts, so results do not depend on their order. ``joint_rmse`` is the root of the
    mean squared error over all targets; ``params`` holds the trial's parameters as JSON, which
    :func:`best_params` reads back.
    """
    spark = train.sparkSession
    trials: list[tuple[str, int, str, float]] = []
    for model, space in spaces.items():
        source = random.Random(seed)
        points = [{**_draw(space, source), **(fixed or {})} for _ in range(n_trials)]
        stages, bins = feature_stages(train, one_hot=model in ONE_HOT)
        fit_rows, val_rows = [
            _model_rows(rows, stages, targets).persist(StorageLevel.MEMORY_AND_DISK)
            for rows in (train, val)
        ]
        try:
            # Both sets are filled by one job each; trials that start together would each compute them.
            fit_rows.count(), val_rows.count()
            with ThreadPoolExecutor(parallel) as pool:
                score = inheritable_thread_target(spark)(_trial_score)
                waiting = [pool.submit(score, fit_rows, val_rows, point, model, bins, seed, targets) for point in points]
                for trial, (point, found) in enumerate(zip(points, waiting, strict=True)):
                    trials.append((model, trial, json.dumps(point, sort_keys=True), found.result()))
        finally:
            fit_rows.unpersist()
            val_rows.unpersist()
    return spark.createDataFrame(
        trials, "model string, trial int, params string, joint_rmse double"
    )


def best_params(trials: DataFrame) -> dict[str, dict[str, Any]]:
    """The parameters of each model's best trial, the first of several."""
    order = Window.partitionBy("model").orderBy("joint_rmse", "trial")
    first = trials.withColumn("_turn", F.row_number().over(order)).where("_turn = 1").collect()
    return {row["model"]: json.loads(row["params"]) for row in first}


def model_report(models: Mapping[str, Mapping[str, PipelineModel]], val: DataFrame) -> DataFrame:
    """RMSE, MAE and R2 of each model on the validation rows, averaged over its targets."""
    reports = []
    for name, fitted in models.items():
        pairs = {t: f"pred_{t}" for t in fitted}
        overall = forecast_metrics(predict(val, fitted), pairs).where("target = 'overall'")
        reports.append(overall.select(F.lit(name).alias("model"), "rmse", "mae", "r2"))
    result = reports[0]
    for other in reports[1:]:
        result = result.unionByName(other)
    return result


def save_models(models: Mapping[str, Mapping[str, PipelineModel]], report: DataFrame, folder: str) -> None:
    """Persist every model per target, and the report beside them."""
    for name, fitted in models.items():
        for target, model in fitted.items():
            model.write().overwrite().save(f"{folder}/models/{name}/{target}")
    report.write.mode("overwrite").parquet(f"{folder}/report")


def load_best(spark, folder: str, targets: Sequence[str] = TARGETS) -> dict[str, PipelineModel]:
    """The saved model with the least RMSE."""
    return load_models(spark, folder, best_model(spark.read.parquet(f"{folder}/report")).first()["model"], targets)


def load_models(spark, folder: str, name: str, targets: Sequence[str] = TARGETS) -> dict[str, PipelineModel]:
    """A saved model by its name."""
    return {t: PipelineModel.load(f"{folder}/models/{name}/{t}") for t in targets}
