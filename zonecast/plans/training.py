"""Feature table to fitted models."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.times import Moment
from zonecast.operators.ml import (
    SEARCH_SPACES, best_params, feature_matrix, model_report, save_models, train_gbt, tune_report,
)
from zonecast.operators.positions import chronological_split
from zonecast.schemas import BIN, FEATURES, TARGETS
from zonecast.session import stage
from zonecast.sources.store import read_features


def split_matrix(panel: DataFrame, train: float = 0.7, val: float = 0.85) -> DataFrame:
    """Model inputs and targets with their split."""
    return feature_matrix(chronological_split(panel, train, val))


def train_and_report(
    panel: DataFrame, params: Mapping[str, Mapping[str, Any]], folder: str | None = None
) -> tuple[dict[str, dict[str, PipelineModel]], DataFrame]:
    """Fit each model of ``params`` on the training rows and report it on the validation rows."""
    rows = stage(split_matrix(panel), "matrix")
    fit_rows = rows.where(F.col("split") == "train")
    models = {name: train_gbt(fit_rows, params=chosen, model=name) for name, chosen in params.items()}
    report = model_report(models, rows.where(F.col("split") == "val"))
    if folder is not None:
        save_models(models, report, folder)
    return models, report


def search_and_train(
    spark: SparkSession,
    path: str,
    start: Moment,
    end: Moment,
    folder: str,
    spaces: Mapping[str, Mapping[str, Mapping[str, Any]]] = SEARCH_SPACES,
    n_trials: int = 20,
    seed: int = 42,
) -> tuple[dict[str, dict[str, PipelineModel]], DataFrame]:
    """The whole training job: read a window of the feature table, split, search, fit, report, save.

    Each model is fitted with the parameters of its best trial. The trials are kept beside the
    models; ``load_best`` reads the best model back.
    """
    panel = stage(read_features(spark, path, [BIN, *FEATURES, *TARGETS], start, end), "training")
    rows = stage(split_matrix(panel), "matrix")
    trials = tune_report(
        rows.where(F.col("split") == "train"), rows.where(F.col("split") == "val"), spaces, n_trials, seed
    )
    trials.write.mode("overwrite").parquet(f"{folder}/trials")
    return train_and_report(panel, best_params(trials), folder)
