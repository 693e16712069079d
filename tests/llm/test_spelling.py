"""Spelling variants against comparing every pair of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonecast.llm.spelling import Acceptor, _parts, spelling_variants, vocabulary


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, least=3):
    counts = Counter()
    for id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if id is None else id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    found = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return found


def made(seed):
    draw = random.Random(seed)
    alphabet = "abÀé×"
    base = ["".join(draw.choices(alphabet, k=draw.choice([4, 5, 6, 7, 12]))) for _ in range(60)] + ["aaaaa" + "b" * 30]
    words = list(base)
    for word in base:
        for _ in range(6):
            at, kind = draw.randrange(len(word)), draw.randrange(3)
            words.append(word[:at] + ("" if kind == 2 else draw.choice(alphabet)) + word[at + (kind != 1) :])
    weights = [draw.choice([1, 2, 5, 30]) for _ in words]
    rows = [(i, draw.choice([" ", ", ", "\n", "1"]).join(w.upper() if draw.random() < 0.1 and w.isascii() else w for w in draw.choices(words, weights, k=draw.choice([0, 1, 30, 200])))) for i in range(60)]
    return [*rows, (None, " ".join(words)), (None, None), (7, ""), rows[3], rows[3], (99, "ΑΒΓΔΕ漢字 ababƀabab")]


@pytest.mark.parametrize(("seed", "part_words"), [(1, 20_000), (2, 12)])
def test_against_all_pairs(spark, seed, part_words):
    rows = made(seed)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, word int").repartition(4)
    got = spelling_variants(df, part_words=part_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows)
    assert any(root not in (word, form) for word, form, root, *_ in found)


def test_full_parts_start_later(spark):
    words = spark.createDataFrame([(f"prefix{chr(97 + i)}{chr(97 + j)}end", 3) for i in range(26) for j in range(20)], "word string, n long")
    sizes = _parts(words, 30).groupBy("longest", "side", "kind", "at", "start").count().agg({"count": "max"}).first()[0]
    assert sizes <= 30


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "abcde abcde abcde")], "doc_id long, text string")
    assert spelling_variants(df.where("false")).count() == 0
    assert vocabulary(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(df, ratio=1)


def test_long_texts(spark):
    df = spark.createDataFrame([(1, "x" * 200_000 + " wordy" * 50_000)] * 3, "doc_id long, text string")
    assert {r["word"][:5]: (r["n"], r["n_near"]) for r in spelling_variants(df).collect()}["wordy"] == (150_000, 0)


@given(st.sets(st.text("abc", max_size=6), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_composition_gives_every_pair_once(words):
    words = sorted(words)
    made = Acceptor(words)
    pairs = [tuple(sorted(pair)) for pair in made.pairs()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(i, j) for j in range(len(words)) for i in range(j) if one_edit(words[i], words[j])}
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in [w[:k] for k in range(len(w) + 1)]}
    assert len(made.final) == len(endings)
