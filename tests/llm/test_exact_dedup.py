"""Exact dedup against a plain grouping, with the hard cases of its rows."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonecast.llm.exact_dedup import drop_exact_copies, exact_groups, golomb_decode, golomb_encode

CASES = [
    (1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (5, "x" * 200_000), (6, "x" * 200_000), (7, "b"), (None, "a"),
    (None, "only"), (8, "a "), (9, "b"), (2, "other"), (10, "ünï\n"), (11, "solo"), (11, "solo"),
]


@given(st.sets(st.integers(0, 2**63 - 1), min_size=1, max_size=60))
@settings(max_examples=60, deadline=None)
def test_codes_come_back(values):
    wanted = np.array(sorted(values), np.int64)
    assert (golomb_decode(golomb_encode(wanted)) == wanted).all()


def brute(cases):
    groups = defaultdict(list)
    for id, text in cases:
        groups[text or ""].append(id)
    found = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for place, id in enumerate(sorted(ids, key=lambda i: (i != keep, i is None, i or 0))):
            found[id, keep, len(ids), place == 0, sha] += 1
    return found


@pytest.mark.parametrize("block_rows", [3, 1 << 18])
def test_groups(spark, block_rows):
    rows = [(i, t, "clash", 1.0) for i, t in CASES]
    df = spark.createDataFrame(rows, "doc_id long, text string, sha string, block double").repartition(3)
    got = exact_groups(df, block_rows=block_rows).drop("same_id").collect()
    assert Counter(tuple(r) for r in got) == brute(CASES)


def test_a_hot_text_and_an_empty_table(spark):
    df = spark.range(3_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', concat('t', id)) AS text")
    got = exact_groups(df)
    assert got.where("group_size = 1000").count() == 1000
    assert got.where("kept").count() == 2001
    assert exact_groups(df.where("false")).count() == 0
    assert drop_exact_copies(df.where("false")).count() == 0


def test_rows_that_stay(spark):
    df = spark.createDataFrame([(i, t, str(k)) for k, (i, t) in enumerate(CASES)], "doc_id long, text string, _id string")
    got = drop_exact_copies(df)
    assert got.columns == df.columns
    wanted = sorted((k[0] or -1, k[4]) for k in brute(CASES) if k[3])
    assert sorted((r[0] or -1, hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in got.collect()) == wanted
