"""The lexical search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from zonecast.llm.lexical import Best, DocumentTree, lexical_search, search_tree, terms_of


def brute(documents, items, top=50):
    split = lambda text: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    held = [(id, split(text)) for id, text in documents]
    held = [(id, Counter(words), len(words)) for id, words in held if words]
    N, L = len(held), sum(n for _, _, n in held)
    df = Counter(term for _, counts, _ in held for term in counts)
    found = Counter()
    for item, text in items:
        scores = []
        for id, counts, n in held:
            m, score = 100 - 50 + (50 * n * N) // L, 0
            for term in set(split(text)):
                if counts[term]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * counts[term]) // (1000 * counts[term] + 20 * m))
            if score > 0:
                scores.append((-score, id is None, id))
        for rank, (score, _, id) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:top], 1):
            found[item, rank, id, -score] += 1
    return found


def made(seed, many=300):
    draw = random.Random(seed)
    words = ["the", "of", "Éa", "x1"] + [f"w{i}" for i in range(200)]
    weights = [300, 200, 80, 60] + [1 + 200 // (i + 1) for i in range(200)]
    text = lambda n: " ".join(draw.choices(words, weights, k=n)).title()
    documents = [(i, text(draw.choice([1, 3, 20, 60, 200]))) for i in range(many)]
    documents += [(1000, None), (1001, ""), (1002, "--- \n"), (None, text(40)), (5, text(30)), (5, documents[7][1]), *[(2000 + k, documents[3][1]) for k in range(30)]]
    documents.append((3000, " ".join(["the w3 w9"] * 40_000)))
    items = [(i, text(draw.choice([1, 4, 25]))) for i in range(12)] + [(90, None), (91, "."), (92, "nowhere"), (3, "of w9"), (None, "w1 w2 W1")]
    return documents, items


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"top": 7, "pass_terms": 40})])
def test_against_every_score(spark, seed, options):
    documents, items = made(seed)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in documents], "doc_id long, text string, item long, n int").repartition(5)
    wanted = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int").repartition(2)
    got = lexical_search(df, wanted, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == brute(documents, items, options.get("top", 50))


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    wanted = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search(df.where("false"), wanted).count() == 0
    assert lexical_search(df, wanted.where("false")).count() == 0
    assert [tuple(r)[:3] for r in lexical_search(df, wanted).collect()] == [(1, 1, 1)]


def tree_of(vectors, m):
    lengths = [len(v) for v in vectors]
    term, tf = [np.array([p[k] for v in vectors for p in sorted(v.items())], np.int64) for k in (0, 1)]
    return DocumentTree(np.arange(len(vectors)), np.array(m), np.concatenate([[0], np.cumsum(lengths)]), term, tf)


def test_paths_are_shared_and_bounds_hold():
    draw = random.Random(4)
    vectors = [{t: draw.randint(1, 9) for t in range(30) if draw.random() < 8 / (t + 8)} or {0: 1} for _ in range(500)]
    m = [draw.randint(50, 400) for _ in vectors]
    tree = tree_of(vectors, m)
    assert len(tree.node_term) == len({tuple(sorted(v))[:k] for v in vectors for k in range(1, len(v) + 1)}) < len(tree.term)
    for node in range(len(tree.node_term)):
        below = tree.ids[tree.low[node] : tree.high[node]]
        assert tree.greatest[node] == max(vectors[d][tree.node_term[node]] for d in below)
        assert tree.least[node] == min(m[d] for d in below)
        assert len({tuple(sorted(vectors[d]))[: tree.node_depth[node] + 1] for d in below}) == 1


def test_branches_that_cannot_reach_the_results_are_left():
    draw = random.Random(6)
    vectors = [{t: 1 for t in range(60) if draw.random() < 20 / (t + 20)} or {0: 1} for _ in range(20_000)]
    m = [draw.randint(90, 110) for _ in vectors]
    tree, best = tree_of(vectors, m), Best(10)
    weights = {3: 10, 40: 2000, 50: 3000, 55: 2500}
    search_tree(tree, weights, best)
    scores = [(-sum(w * (10**9 * v[t] // (1000 * v[t] + 20 * x)) for t, w in weights.items() if t in v), d) for d, (v, x) in enumerate(zip(vectors, m, strict=True))]
    assert list(zip(-best.scores, best.ids, strict=True)) == sorted(scores)[:10]
    assert best.seen < 10_000


def test_terms():
    assert terms_of("It's É-x_1 ÀB c\x7fD") == ["it".encode(), b"s", "É".encode(), b"x", b"1", "Àb c".encode(), b"d"]
