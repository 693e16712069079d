from __future__ import annotations

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from zonecast.operators import forest, ml, trees
from zonecast.schemas import FEATURES, TARGETS


@pytest.fixture(scope="module")
def panel(spark):
    """Rows of 40 zones whose targets follow the hour, the zone and chance."""
    source = random.Random(5)
    made = []
    for i in range(900):
        hour, zone = source.randrange(24), source.randrange(40)
        row = {name: round(source.random() * 20, 1) for name in FEATURES}
        row |= {"zone_id": zone, "pickup_hour": hour, "day_of_week": i % 7, "is_rush_hour": int(hour in (7, 8)), "is_night_hour": 0, "pickup_month": 1}
        row |= {t: float(hour * (k + 1) + 30 * (zone in (3, 4)) + source.random()) for k, t in enumerate(TARGETS)}
        made.append(row | {"id": i})
    return spark.createDataFrame(made).repartition(3, "id").cache()


@pytest.fixture
def unlaid(monkeypatch):
    """No one-hot column is laid out, and Spark's own forest is out of reach."""
    monkeypatch.setattr(ml, "LAID_OUT_BYTES", 0)

    def refuse(*_):
        raise AssertionError("the columns were laid out")

    monkeypatch.setattr(RandomForestRegressor, "_fit", refuse)


def forecasts(df, models):
    return {r["id"]: [r[f"pred_{t}"] for t in TARGETS] for r in ml.predict(df, models).collect()}


WHOLE = {"numTrees": 2, "maxDepth": 4, "bootstrap": False, "featureSubsetStrategy": "all", "minInstancesPerNode": 3}


def test_without_chance_the_forest_is_that_of_spark(panel, monkeypatch):
    wanted = ml.train_gbt(panel, params=WHOLE, model="random_forest")
    monkeypatch.setattr(ml, "LAID_OUT_BYTES", 0)
    monkeypatch.setattr(forest, "CHUNK_ROWS", 100)
    got = ml.train_gbt(panel, params=WHOLE, model="random_forest")
    for t in TARGETS:
        ours, theirs = got[t].stages[-1], wanted[t].stages[-1]
        assert ours.numFeatures == theirs.numFeatures and ours.getNumTrees == 2 and ours.getMaxDepth() == 4
        assert ours.totalNumNodes == theirs.totalNumNodes
    # Columns that part the rows of a node alike are equally good; either gives these rows the same forecasts.
    a, b = forecasts(panel, got), forecasts(panel, wanted)
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)


def test_wide_forests_learn_save_and_load(spark, panel, request, tmp_path):
    theirs = ml.model_report({"random_forest": ml.train_gbt(panel, params={"numTrees": 12, "maxDepth": 5}, model="random_forest")}, panel)
    wanted = theirs.first()["r2"]
    request.getfixturevalue("unlaid")
    models = ml.train_gbt(panel, params={"numTrees": 12, "maxDepth": 5}, model="random_forest")
    report = ml.model_report({"random_forest": models}, panel)
    assert abs(report.first()["r2"] - wanted) < 0.1
    ml.save_models({"random_forest": models}, report, str(tmp_path))
    loaded = ml.load_best(spark, str(tmp_path))
    assert forecasts(panel, loaded) == forecasts(panel, models)
    stored = trees.predict_by_table(panel, loaded[TARGETS[0]].stages[0], trees.tree_nodes(loaded), TARGETS)
    wanted = forecasts(panel, models)
    assert all([r[f"pred_{t}"] for t in TARGETS] == pytest.approx(wanted[r["id"]]) for r in stored.collect())
    assert forecasts(panel.withColumn("zone_id", F.lit(99)), models).keys() == wanted.keys()
    # Trees differ, as each has draws of its own, and the same seed draws the same.
    assert len({tree.toDebugString.split("\n", 1)[1] for tree in models[TARGETS[0]].stages[-1].trees}) == 12
    again = ml.train_gbt(panel, params={"numTrees": 12, "maxDepth": 5}, model="random_forest")
    assert forecasts(panel, again) == wanted


def test_each_tree_draws_its_rows_with_replacement(spark):
    draw = forest._drawing(3, 1.0, 2, True)
    rows = spark.range(0, 20000, 1, 2).mapInArrow(draw, "id bigint, w0 tinyint, w1 tinyint")
    mean, spread, together, none = rows.agg(F.avg("w0"), F.var_pop("w1"), F.corr("w0", "w1"), F.avg((F.col("w0") == 0).cast("int"))).first()
    assert abs(mean - 1) < 0.04 and abs(spread - 1) < 0.06 and abs(together) < 0.04 and abs(none - 0.3679) < 0.02


def test_columns_tried_follow_the_strategies_of_spark():
    names = {"auto": 34, "onethird": 34, "sqrt": 10, "log2": 7, "all": 100, "5": 5, "0.25": 25, "1": 1, "1.0": 100, "700": 100}
    assert {name: forest.columns_tried(name, 100, 20) for name in names} == names
    assert forest.columns_tried("auto", 100, 1) == 100


def test_missing_targets_are_refused(panel, unlaid):
    holes = panel.withColumn(TARGETS[1], F.when(F.col("id") != 7, F.col(TARGETS[1])))
    with pytest.raises(Exception, match="rows without a value"):
        ml.train_gbt(holes, params={"numTrees": 2, "maxDepth": 2}, model="random_forest")


def test_features_are_made_once_a_row_when_trees_score(spark):
    leaf = (None, None, None, None, None)
    made = [(t, 0, 1.0, *node) for t in "yz" for node in ((0, 1, 2.0, None, 1, 2, 0.0), (1, *leaf, 5.0), (2, *leaf, 7.0))]
    rows = spark.createDataFrame([(1, Vectors.dense(0.0, 2.0)), (2, Vectors.sparse(2, [1], [3.0]))], ["id", "v"])
    scored = trees.score_trees(rows, spark.createDataFrame(made, trees.NODES), vector_to_array("v"), ("y", "z"))
    assert scored.columns == ["id", "v", "pred_y", "pred_z"]
    assert sorted(r["pred_z"] for r in scored.collect()) == [5.0, 7.0]
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("UDF(v") == 1
