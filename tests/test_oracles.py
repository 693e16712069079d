"""Every query with SQL gives the rows of that SQL on the shared tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from checks.registry import ORACLES, QUERIES
from checks.compare import connect, differences

SLOW_MODELS = {"train_gbt", "train_forest_one_hot", "score_gbt", "tune_report", "model_report"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    result = QUERIES[name](spark, sf_dir).toPandas()
    expected = con.sql(ORACLES[name]).df()
    assert len(expected) > 0
    assert differences(result, expected) == []


def test_names_without_sql():
    assert set(QUERIES) - set(ORACLES) == SLOW_MODELS


def test_entry_has_rows(spark, sf_dir):
    assert entry(spark).count() > 0
