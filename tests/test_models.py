from __future__ import annotations

import json
from collections import Counter
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from checks import model_queries
from zonecast.operators import ml, trees
from zonecast.functions.times import hour_text
from zonecast.plans.training import search_and_train, train_and_report
from zonecast.schemas import CATEGORICAL, FEATURES, TARGETS
from zonecast.sources.store import upsert_features

TREES = {"maxIter": 2, "maxDepth": 3}


@pytest.fixture(scope="module")
def panel(spark):
    """Small feature rows: targets follow the hour and the zone."""
    base = spark.range(600).select(
        (F.timestamp_seconds(F.col("id") * 3600)).cast("timestamp_ntz").alias("bin"),
        (F.col("id") % 5).cast("int").alias("zone_id"),
        (F.col("id") % 24).cast("int").alias("pickup_hour"),
    )
    rest = {n: F.lit(1.0) for n in FEATURES if n not in base.columns}
    rest["precip"] = F.when(F.col("pickup_hour") > 3, 0.5)
    targets = {t: (F.col("pickup_hour") * (i + 1) + F.col("zone_id")) for i, t in enumerate(TARGETS)}
    return base.withColumns(rest).withColumns(targets).cache()


def test_matrix_has_25_features_and_no_times(panel):
    assert len(FEATURES) == 25 and len(CATEGORICAL) == 6
    matrix = ml.feature_matrix(panel.withColumn("split", F.lit("train")))
    assert matrix.columns == [*FEATURES, *TARGETS, "split"]


def test_training_learns_saves_and_scores(spark, panel, tmp_path):
    params = {"gbt": TREES, "random_forest": {"numTrees": 3, "maxDepth": 3}}
    models, report = train_and_report(panel, params, str(tmp_path))
    scores = {r["model"]: r for r in report.collect()}
    assert set(scores) == {"gbt", "random_forest"} and scores["gbt"]["r2"] > 0.8
    best = ml.load_best(spark, str(tmp_path))
    assert set(best) == set(TARGETS)
    got = ml.score_gbt(panel, best)
    assert got.count() == 600 and got.where("target_yellow < 0").count() == 0
    assert dict(got.dtypes)["target_green"] == "int"


def test_a_table_of_nodes_scores_as_the_fitted_models(panel):
    for model, params in (("gbt", TREES), ("random_forest", {"numTrees": 5, "maxDepth": 4})):
        models = ml.train_gbt(panel, params=params, model=model)
        nodes = trees.tree_nodes(models).cache()
        assert [name for name, _ in nodes.dtypes] == [part.split()[0] for part in trees.NODES.split(", ")]
        assert nodes.where("categories is not null").count() + nodes.where("threshold is not null").count() == nodes.where("left is not null").count()
        wanted = ml.predict(panel, models)
        got = trees.predict_by_table(panel, models[TARGETS[0]].stages[0], nodes, TARGETS)
        assert got.columns == wanted.columns
        keys = ["bin", "zone_id"]
        both = got.select(*keys, *[F.col(f"pred_{t}").alias(f"own_{t}") for t in TARGETS]).join(wanted, keys)
        worst = both.agg(*[F.max(F.abs(F.col(f"own_{t}") - F.col(f"pred_{t}"))) for t in TARGETS], F.count(F.lit(1))).first()
        assert worst[3] == 600 and all(gap < 1e-9 for gap in worst[:3])


def test_scoring_by_hand_written_trees(spark):
    leaf = (None, None, None, None, None)
    made = [
        ("y", 0, 1.0, 0, 0, 5.0, None, 1, 2, 0.0), ("y", 0, 1.0, 1, *leaf, 10.0), ("y", 0, 1.0, 2, 1, None, [1.0, 3.0], 3, 4, 0.0),
        ("y", 0, 1.0, 3, *leaf, 20.0), ("y", 0, 1.0, 4, *leaf, 30.0), ("y", 1, 0.5, 0, *leaf, 2.0),
    ]
    nodes = spark.createDataFrame(made, trees.NODES)
    rows = spark.createDataFrame([(1, [5.0, 9.0]), (2, [6.0, 3.0]), (3, [6.0, 2.0]), (4, [None, None]), (5, None)], "id int, x array<double>")
    got = {r["id"]: (r["pred_y"], r["pred_z"]) for r in trees.score_trees(rows, nodes, F.col("x"), ("y", "z")).collect()}
    assert got == {1: (11.0, None), 2: (21.0, None), 3: (31.0, None), 4: (31.0, None), 5: (31.0, None)}
    plan = trees.score_trees(rows, nodes, F.col("x"), ("y",))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Python" not in plan


def test_unseen_zones_can_be_scored(panel):
    models = ml.train_gbt(panel, params=TREES)
    assert ml.predict(panel.withColumn("zone_id", F.lit(99)), models).count() == 600


def test_the_list_decides_what_is_a_category(panel):
    many = panel.withColumn("zone_id", F.monotonically_increasing_id())
    stages, bins = ml.feature_stages(many)
    assert bins == panel.count() + 1
    stages, bins = ml.feature_stages(many, categorical=("pickup_hour",))
    assert bins == 32
    with pytest.raises(ValueError, match="zone_id"):
        ml.feature_stages(panel.withColumn("zone_id", F.array("zone_id")))


def test_bins_of_numbers_do_not_follow_the_categories(spark):
    rows = spark.range(3000).select(
        F.col("id").cast("int").alias("zone_id"), (F.col("id") % 1000).cast("double").alias("temp"),
        F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(0).cast("double").alias("humidity"), F.lit(1.0).alias("precip"),
    )
    edges = dict(zip(("temp", "humidity", "precip"), ml.bin_edges(rows, ("temp", "humidity", "precip")), strict=True))
    assert all(len(cuts) - 1 <= ml.CONTINUOUS_BINS and cuts == sorted(set(cuts)) for cuts in edges.values())
    # Rare values keep cuts of their own although nearly all rows hold another one.
    assert sum(0 < cut < float("inf") for cut in edges["humidity"]) >= 10 and len(edges["precip"]) == 3
    stages, bins = ml.feature_stages(rows, ("zone_id", "temp", "humidity"), ("zone_id",))
    assert bins == 3001
    made = ml.vectors(rows, stages, ("zone_id", "temp", "humidity"))
    assert max(r["features"][0] for r in made.collect()) < ml.CONTINUOUS_BINS
    assert ml.vectors(rows.withColumn("temp", F.lit(-1e9)), stages, ("zone_id", "temp", "humidity")).count() == 3000


def test_trials_do_not_depend_on_how_many_run_together(panel):
    spaces = {"gbt": ml.SEARCH_SPACES["gbt"]}
    alone, together = (ml.tune_report(panel, panel, spaces, n_trials=3, fixed=TREES, parallel=n).collect() for n in (1, 3))
    assert alone == together
    assert all(0.6 <= float(json.loads(r["params"])["featureSubsetStrategy"]) <= 1.0 for r in alone)


def test_search_is_repeatable(panel):
    spaces = {"gbt": ml.SEARCH_SPACES["gbt"]}
    run = lambda: ml.tune_report(panel, panel, spaces, n_trials=2, fixed=TREES).collect()
    first = run()
    assert first == run() and len({r["params"] for r in first}) == 2


def test_the_whole_job_searches_and_saves(spark, panel, tmp_path):
    path = str(tmp_path / "features")
    upsert_features(panel.withColumns({"bin_str": hour_text(F.col("bin")), "pickup_year": F.year("bin")}), path)
    spaces = {"gbt": {"maxIter": {"type": "int", "low": 2, "high": 3}, "maxDepth": {"type": "int", "low": 2, "high": 3}}}
    models, report = search_and_train(spark, path, "1970-01-01", "1970-01-20", str(tmp_path / "run"), spaces, n_trials=2)
    trials = spark.read.parquet(str(tmp_path / "run" / "trials"))
    assert trials.count() == 2 and ml.best_params(trials)["gbt"].keys() == {"maxIter", "maxDepth"}
    assert set(models) == {"gbt"} and report.count() == 1
    assert set(ml.load_best(spark, str(tmp_path / "run"))) == set(TARGETS)


def test_tuning_query_searches_all_of_both_spaces(monkeypatch):
    monkeypatch.setattr(ml, "_model_rows", lambda *a: MagicMock())
    monkeypatch.setattr(ml, "feature_stages", lambda *a, **b: (None, 0))
    monkeypatch.setattr(ml, "inheritable_thread_target", lambda session: lambda run: run)
    monkeypatch.setattr(ml, "joint_rmse", lambda *a: MagicMock())
    tried = []
    monkeypatch.setattr(ml, "_fit_targets", lambda rows, targets, point, model, *a: tried.append((model, point)) or {})
    monkeypatch.setattr(model_queries, "_split", lambda spark, sf: (MagicMock(), MagicMock()))
    model_queries.tuned(None, "")
    assert Counter(model for model, _ in tried) == {"gbt": 20, "random_forest": 20}
    for model, point in tried:
        assert set(point) == set(ml.SEARCH_SPACES[model])
    assert len({point["maxDepth"] for model, point in tried if model == "gbt"}) > 1


def test_model_queries_fit_the_default_models(monkeypatch):
    for name in ("stage", "split_matrix", "_features"):
        monkeypatch.setattr(model_queries, name, lambda *a: MagicMock())
    fitted, reported = [], []
    monkeypatch.setattr(ml, "train_gbt", lambda df, params=None, model="gbt": fitted.append((model, params or {})) or {})
    monkeypatch.setattr(ml, "predict", lambda *a: MagicMock())
    monkeypatch.setattr(ml, "score_gbt", lambda *a: MagicMock())
    monkeypatch.setattr(model_queries, "train_and_report", lambda panel, params: reported.append(params) or ({}, None))
    for run in (model_queries.trained, model_queries.scored, model_queries.forest, model_queries.report):
        run(None, "")
    assert fitted == [("gbt", {}), ("gbt", {}), ("random_forest", {})]
    assert reported == [{"gbt": {}, "random_forest": {}}]
