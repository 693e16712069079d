"""Tree ensembles as tables of nodes, scored by native expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.operators.ml import VECTOR, vectors
from zonecast.session import new_stage_path

NODES = (
    "target string, tree int, weight double, node int, feature int, threshold double, categories array<double>, "
    "left int, right int, prediction double"
)
DEEPEST = 30  # levels of a tree, the limit of Spark's own


def tree_nodes(models: Mapping[str, PipelineModel]) -> DataFrame:
    """The nodes of each target's fitted ensemble, as ``NODES`` names them.

    A tree's root is node 0. Of a numeric split ``threshold`` is set, and what is at most that goes
    left; of a categorical split ``categories`` is set, and its values go left. A leaf has neither
    and no children. Forecasts are the sum of the trees' leaves by ``weight``. Nodes are read from
    the files that the models are saved to, so no ensemble passes through the driver.
    """
    spark, tables = SparkSession.active(), []
    for target, model in models.items():
        ensemble, path = model.stages[-1], new_stage_path(spark, "ensemble")
        ensemble.write().save(path)
        share = float(ensemble.getNumTrees) if isinstance(ensemble, RandomForestRegressionModel) else 1.0
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight")
        saved = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
        leaf, numeric = F.col("leftChild") < 0, F.col("split.numCategories") < 0
        values = F.col("split.leftCategoriesOrThreshold")
        inner = lambda value: F.when(~leaf, value)
        tables.append(
            saved.join(weights.select("tree", "weight"), "tree").select(
                F.lit(target), "tree", F.col("weight") / share, "id", inner(F.col("split.featureIndex")),
                inner(F.when(numeric, F.get(values, F.lit(0)))), inner(F.when(~numeric, values)),
                inner(F.col("leftChild")), inner(F.col("rightChild")), "prediction",
            ).toDF(*[name.split()[0] for name in NODES.split(", ")])
        )
    return reduce(DataFrame.unionByName, tables)


def _packed(nodes: DataFrame, target: str) -> Column:
    """All trees of a target as one value: arrays of nodes, each at the place of its number."""
    inner = ("node", "feature", "threshold", "categories", "left", "right", "prediction")
    trees = nodes.where(F.col("target") == target).groupBy("tree").agg(
        F.any_value("weight").alias("weight"), F.sort_array(F.collect_list(F.struct(*inner))).alias("nodes")
    )
    return trees.agg(F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes")))).scalar()


def _leaf(nodes: Column, features: Column, depth: int) -> Column:
    """The forecast of one tree: from the root down, ``depth`` levels at most."""

    def step(at: Column, _: Column) -> Column:
        value = F.get(features, at["feature"])
        left = F.when(at["categories"].isNotNull(), F.array_contains(at["categories"], value)).otherwise(value <= at["threshold"])
        return F.when(at["left"].isNull(), at).otherwise(F.get(nodes, F.when(left, at["left"]).otherwise(at["right"])))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.get(nodes, F.lit(0)), step)["prediction"]


def score_trees(
    df: DataFrame, nodes: DataFrame, features: Column, targets: Sequence[str], depth: int = DEEPEST
) -> DataFrame:
    """Add ``pred_{target}``: the ensemble in ``nodes`` applied to the array ``features`` of each row.

    Nodes of a tree are numbered from 0 without gaps. The ensemble reaches the rows as one scalar
    value, whose size is that of the model, and never grows with them; scoring needs no shuffle and
    no Python. A null feature goes right at every split; a target without trees gets null.
    """
    held = {t: f"_trees_{t}" for t in targets}
    # A column of their own: the trees are a subquery, which may not stand inside a function over arrays.
    # So are the features: named within that function, they would be made anew at every step down every tree.
    rows = df.withColumns({name: _packed(nodes, t) for t, name in held.items()} | {"_features": features})
    add = lambda total, tree: total + tree["weight"] * _leaf(tree["nodes"], F.col("_features"), depth)
    scores = {
        f"pred_{t}": F.when(F.size(name) > 0, F.aggregate(name, F.lit(0.0), add)) for t, name in held.items()
    }
    return rows.withColumns(scores).drop("_features", *held.values())


def predict_by_table(df: DataFrame, stages: PipelineModel, nodes: DataFrame, targets: Sequence[str]) -> DataFrame:
    """What ``predict`` gives for the models behind ``nodes``, from their feature stages and the table."""
    return score_trees(vectors(df, stages), nodes, vector_to_array(VECTOR), targets).drop(VECTOR)
