"""The Jaccard join against all pairs compared one by one."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from zonecast.llm import near_duplicates
from zonecast.llm.near_duplicates import components, jaccard_components, one_per_component


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 5 else frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(rows):
    sets, root = [shingles(text) for _, text in rows], list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
                root[max(top(a), top(b))] = min(top(a), top(b))
    ids = defaultdict(list)
    for k, (id, _) in enumerate(rows):
        ids[top(k)].append(id)
    found = Counter()
    for k, (id, _) in enumerate(rows):
        known = [i for i in ids[top(k)] if i is not None]
        found[id, len(sets[k]), min(known) if sets[k] and known else id if not sets[k] else None] += 1
    return found


def made(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(10):
        base = [draw.choice(words) for _ in range(draw.choice([4, 6, 20, 60, 150]))]
        for _ in range(draw.choice([1, 3, 25])):
            own = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 3, 5, 8])):
                own[draw.randrange(len(own))] = draw.choice(words)
            text = " ".join(own)
            texts.append(text.upper() if draw.random() < 0.2 else text)
    rows = list(enumerate(texts))
    return [*rows, (None, texts[0]), (500, None), (501, ""), (502, " \n"), rows[3], *[(600 + k, texts[5]) for k in range(20)]]


@pytest.mark.parametrize("seed", [3, 4])
def test_components_of_documents(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, node int, token int").repartition(5)
    got = jaccard_components(df).collect()
    assert Counter(tuple(r) for r in got) == brute(rows)


@pytest.mark.parametrize("seed", [5, 6])
def test_short_texts_with_words_added_and_cut_off(spark, seed):
    draw, rows = random.Random(seed), []
    for k in range(80):
        base = [f"t{k}_{i}_{draw.randrange(1000)}" for i in range(draw.choice([8, 12, 13, 20, 24, 44, 84]))]
        room = (len(base) - 4) // 4
        rows += [(3 * k, " ".join(base)), (3 * k + 1, " ".join([*base, *[f"end{i}" for i in range(room)]]))]
        rows.append((3 * k + 2, " ".join(base[room // 2 : len(base) - (room + 1) // 2])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(tuple(r) for r in jaccard_components(df).collect()) == brute(rows)


def test_one_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (3, text + " end"), (9, "short one"), (2, None), (7, ""), (8, text.upper())]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _id string")
    got = one_per_component(df)
    assert got.columns == df.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [2, 3, 7, 9]
    assert one_per_component(df.where("false")).count() == 0


def test_one_stays_where_ids_are_null_or_repeated(spark):
    text, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [
        (1, text), (None, text + " end"), (None, "clean one"), (None, "clean two"), (None, None), (None, " \x0b"),
        (1, "clean three"), (2, text.upper()), (2, "clean four"), (None, other), (None, other + " end"), (7, "same words"), (7, "SAME words"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in one_per_component(df).collect())
    both = [(None, other), (None, other + " end")]
    assert sum(got[row] for row in both) == 1
    same = [(7, "SAME words"), (7, "same words")]
    assert sum(got[row] for row in same) == 1
    assert Counter({r: n for r, n in got.items() if r not in both + same}) == Counter([rows[0], *rows[2:7], rows[8]])


def test_star_rounds(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    df = spark.createDataFrame(chain, "a long, b long")
    labels = dict(map(tuple, components(df).collect()))
    assert {labels[i] for i in range(31)} == {0} and {labels[i] for i in range(100, 160)} == {100}
    assert 7 in labels and len(labels) == 91


@pytest.mark.parametrize("carried", [0, 60, 2048])
def test_copies_of_one_text_that_do_not_link_to_it(spark, monkeypatch, carried):
    """Edits near the limit: members of one list in many components, with and without arrays in its rows."""
    monkeypatch.setattr(near_duplicates, "CARRIED", carried)
    draw, rows = random.Random(7), []
    for size in (40, 90):
        base = [f"b{size}_{i}" for i in range(size)]
        for k in range(110):
            own = list(base)
            for _ in range(draw.choice([0, 1, size // 50 + 1, size // 40 + 1, size // 25, size // 20])):
                own[draw.randrange(size)] = f"x{draw.randrange(40)}"
            rows.append((1000 * size + k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(tuple(r) for r in jaccard_components(df).collect())
    assert got == brute(rows) and len({component for *_, component in got}) > 10
