"""Language, quality, toxicity and top-k: brute force, held-out accuracy and hard rows."""

from __future__ import annotations

import math
import random
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from zonecast.llm import common, language, quality, toxicity
from zonecast.llm.top_k import LEVELS, segment_statistics, top_k

SCHEMA = "doc_id long, text string, lang string"


def cuts(word, pieces, longest):
    if not word:
        yield []
    for n in range(1, min(longest, len(word)) + 1):
        if n == 1 or word[:n] in pieces:
            for rest in cuts(word[n:], pieces, longest):
                yield [word[:n], *rest]


def test_forward_sums_all_segmentations():
    pieces = sorted({"a", "b", "ab", "ba", "aba", "▁a", "▁"})
    lattice = language.Lattice(pieces)
    draw = np.random.default_rng(1)
    chances = draw.random((len(pieces) + 1, 2))
    words = ["a", "abab", "bca", "aab"]
    place = {piece: i for i, piece in enumerate(pieces)}
    got = language.log_chances(words, lattice, chances)
    for word, found in zip(words, got, strict=True):
        for column in range(2):
            total = sum(
                math.prod(chances[place.get(piece, len(pieces)), column] for piece in cut)
                for cut in cuts("▁" + word, place, lattice.longest)
            )
            assert found[column] == pytest.approx(math.log(total))


def test_expected_counts():
    pieces = sorted({"a", "b", "ab", "▁"})
    lattice = language.Lattice(pieces)
    chance = np.array([0.3, 0.2, 0.4, 0.1, 1e-7])
    place = {piece: i for i, piece in enumerate(pieces)}
    got = language.expected_counts(["abab"], np.array([[2.0]]), lattice, chance)
    weights, sums = 0.0, np.zeros(5)
    for cut in cuts("▁abab", place, 2):
        weight = math.prod(chance[place[piece]] for piece in cut)
        weights += weight
        for piece in cut:
            sums[place[piece]] += 2 * weight
    assert got[:, 0] == pytest.approx(sums / weights)
    assert np.isfinite(language.expected_counts(["ab" * 3_000], np.ones((1, 1)), lattice, chance)).all()


def test_languages(spark):
    draw = random.Random(2)
    syllables = {"x": ["the", "ing", "er"], "y": ["ción", "os", "que"]}
    text = lambda lang, n: " ".join("".join(draw.choices(syllables[lang], k=3)) for _ in range(n))
    rows = [(i, text("xy"[i % 2], 20), "xy"[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    pieces = ["the", "ing", "er", "os", "que", "c", "i", "ó", "n", "t", "h", "e", "r"]
    model = language.fit_languages(df.where("doc_id < 100"), pieces)
    more = [(None, rows[0][1], None), (900, None, "x"), (901, "", "x"), (902, "123 !", "x"), (903, rows[1][1] * 300, "y")]
    tested = spark.createDataFrame([*rows[100:], *more], SCHEMA).withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in language.predict_language(tested, model).collect()}
    assert all(got[i]["lang_pred"] == rows[i][2] for i in range(100, 200))
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 902))
    assert got[903]["lang_pred"] == "y" and got[None]["lang_pred"] == "x"
    nothing = language.fit_languages(df.where("false"), pieces)
    assert language.predict_language(tested, nothing).where("lang_pred <> 'und'").count() == 0
    assert language.predict_language(df.where("false"), model).count() == 0


def test_marginals_against_all_labellings():
    emissions = np.array([1.0, -2.0, 0.5, 3.0, -1.0])
    counts = np.array([3, 1, 1])
    moves = np.array([[0.7, 0.3], [0.1, 0.9]])
    chance, pairs = quality.marginals(emissions, counts, moves)
    weights = {}
    for labels in product((0, 1), repeat=3):
        score = math.prod(math.exp(emissions[i]) ** y for i, y in enumerate(labels))
        weights[labels] = score * moves[labels[0], labels[1]] * moves[labels[1], labels[2]]
    total = sum(weights.values())
    for i in range(3):
        assert chance[i] == pytest.approx(sum(w for y, w in weights.items() if y[i]) / total)
    assert pairs.sum() == pytest.approx(2)
    assert pairs[0, 1] == pytest.approx(sum(w * sum((a, b) == (0, 1) for a, b in zip(y, y[1:], strict=False)) for y, w in weights.items()) / total)


def test_quality_of_documents(spark):
    draw = random.Random(3)
    line = lambda: " ".join(draw.choices(["the", "of", "house", "water", "and", "small"], k=12)) + "."
    junk = lambda: " ".join(w.upper() + "!!" for w in draw.choices(["the", "of", "house"], k=12))
    rows = [(i, "\n".join((line if i % 2 else junk)() for _ in range(4)), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(7, None), (None, 1), (5, 1)], "doc_id long, quality int")
    model = quality.fit_quality(df, labels, F.col("doc_id") % 5 != 0)
    more = spark.createDataFrame([(900, None, None), (901, "", None), (902, "\n" * 3_000, None), (None, rows[1][1], "x")], df.schema)
    got = {r["doc_id"]: r["score"] for r in quality.quality(df.unionByName(more), model).collect()}
    assert all((got[i] >= 0.3) == bool(y) for i, _, y in rows)
    assert all(0 <= got[i] <= 1 for i in (900, 901, 902)) and got[900] == got[901] and got[None] == got[1]
    none = quality.fit_quality(df, labels.where("false"), F.lit(True))
    assert {r["score"] for r in quality.quality(more, none).collect()} == {0.5}
    assert quality.quality(df.where("false"), model).count() == 0


def test_restored_words(spark):
    df = spark.createDataFrame([("the idiot and the moron are stupid losers in a hot trash town " * 20,)], "text string")
    chances = toxicity.character_chances(df)
    for chunk, word in (("1d10t", "idiot"), ("st00pid!!", None), ("i.d.i.o.t", "idiot"), ("m0r0n,", "moron"), ("iiiidiot", "idiot"), ("TRASH", "trash")):
        found = toxicity.words_in(chunk, chances)
        assert len(found) == 1 and (word is None or found == [word]), chunk
    assert toxicity.chunks_of("an i d i o t here") == ["an", "idiot", "here"]
    assert toxicity.words_in("1007", chances) == [] and toxicity.words_in("***", chances) == []
    assert toxicity.words_in("naïve", chances) == ["naïve"]


def readings(observed, chances):
    """Every reading of a lattice with its best score, by all choices at every sign."""
    best = {}

    def go(i, word, score):
        if i == len(observed):
            codes = [26, 26, *(ord(c) - 97 for c in word), 26]
            total = score + sum(chances[a, b, c] for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))
            best[word] = max(best.get(word, -math.inf), total)
            return
        sign = observed[i]
        if "a" <= sign <= "z":
            go(i + 1, word + sign, score)
            if i and observed[i - 1] == sign:
                go(i + 1, word, score + toxicity.SHORTEN)
        else:
            for letter in toxicity.LEET.get(sign, ""):
                go(i + 1, word + letter, score + toxicity.SWAP)
            go(i + 1, word, score + toxicity.DROP)

    go(0, "", 0.0)
    return best


@pytest.mark.parametrize("seed", range(5))
def test_restored_is_the_best_of_all_readings(seed):
    draw, pick = np.random.default_rng(seed), random.Random(seed)
    chances = np.log(draw.dirichlet(np.ones(27), size=(27, 27)))
    for _ in range(60):
        observed = "".join(pick.choice(["a", "b", "s", "1", "6", "@", "$", ".", "|"]) for _ in range(pick.randrange(1, 9)))
        best = readings(observed + observed[-1], chances)
        assert best[toxicity.restored(observed + observed[-1], chances)] == pytest.approx(max(best.values()))
    assert len(toxicity.restored("ab1" * 30_000, chances)) >= 60_000


def test_fitting_takes_long_words():
    pieces = language.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    lattice = language.Lattice(pieces)
    even = np.full(len(pieces) + 1, 1 / len(pieces))
    word = "".join(random.Random(1).choices("aeinrst", k=20_000))
    counts = language.expected_counts([word], np.ones((1, 1)), lattice, even)
    lengths = np.array([*map(len, pieces), 1])
    assert (counts[:, 0] * lengths).sum() == pytest.approx(len(word) + 1)


def test_toxic_documents(spark):
    draw = random.Random(4)
    words = ["river", "house", "green", "walks", "small", "table", "window", "paper"]
    rows = []
    for i in range(400):
        own = draw.choices(words, k=30)
        if i % 4 == 0:
            own[draw.randrange(30)] = draw.choice(["idiot", "1d10t", "moron"])
            own[draw.randrange(30)] = draw.choice(["idiot", "moron", "i d i o t"])
        rows.append((i, " ".join(own), "en"))
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(df, labels, F.col("doc_id") % 3 != 1)
    more = spark.createDataFrame([(900, None, None), (901, "", None), (902, "river " * 50_000, None), (None, rows[0][1], None)], SCHEMA)
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(df.unionByName(more), model).collect()}
    held = [i for i in range(400) if i % 3 == 1]
    assert sum((got[i] >= 0.7) == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert got[900] == got[901] < 0.7 and got[902] < 0.7 and got[None] == got[0]
    nothing = toxicity.fit_toxicity(df, labels.where("false"), F.lit(True))
    assert {r["score"] for r in toxicity.toxicity(more, nothing).collect()} == {0.5}
    assert toxicity.toxicity(df.where("false"), model).count() == 0


def test_toxicity_reads_few_whole_texts_at_once(spark, monkeypatch):
    """The query and the stage ask for batches of a slice, a task's counts are cut, and neither changes a score."""
    before, seen = spark.conf.get(common.BATCH_KEY), {}

    def watched(df, label, stage=common.stage):
        seen.setdefault(label, int(spark.conf.get(common.BATCH_KEY)))
        return stage(df, label)

    monkeypatch.setattr(common, "stage", watched)
    rows = [(i, f"river house {'idiot moron' if i % 2 else 'green walks'} w{i}", "en") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    whole = toxicity.fit_toxicity(df, labels, F.lit(True))
    monkeypatch.setattr(toxicity, "COUNTED_MARKS", 5)
    cut = toxicity.fit_toxicity(df, labels, F.lit(True))
    assert cut.lexicon == whole.lexicon != {} and np.allclose(cut.final, whole.final, rtol=1e-9)
    assert {r["doc_id"] for r in toxicity.toxicity(df, cut).where("score >= 0.7").collect()} == set(range(1, 60, 2))
    monkeypatch.setattr(corpus_pipeline, "labels", lambda *_: labels)
    assert {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, df, "").collect()} == set(range(0, 60, 2))
    assert seen["llm-marks"] == seen["llm-toxicity"] == seen["llm-clean"] == common.SLICE_ROWS
    assert spark.conf.get(common.BATCH_KEY) == before


def test_bounds_hold():
    draw = np.random.default_rng(5)
    a, b = draw.integers(-300, 300, (40, 13)), draw.integers(-300, 300, (50, 13))
    for level in LEVELS:
        assert (segment_statistics(a, level) @ segment_statistics(b, level).T + 1e-6 >= a @ b.T).all()


def test_top_k(spark):
    draw = random.Random(6)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(9)], i) for i in range(300)]
    rows += [(1_000 + i, rows[3][1], 0) for i in range(40)] + [(400, None, 0), (401, [1.0, None], 0), (402, [math.nan] * 9, 0)]
    rows += [(403, [math.inf] * 9, 0), (None, rows[0][1], 0), (7, rows[7][1], 0), (450, [], 0), (500, [0.5, 0.5], 0), (451, [0.25, 0.5], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(4)
    valid = [
        (i, [math.floor(256 * x) for x in np.array(v, np.float32).astype(float)])
        for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    wanted = []
    for q, own in {i: v for i, v in valid if i % 50 == 0}.items():
        scores = sorted((-sum(map(int.__mul__, own, v)), i) for i, v in valid if i != q and len(v) == len(own))[:5]
        wanted += [(q, rank, i, -score) for rank, (score, i) in enumerate(scores, 1)]
    assert sorted(map(tuple, top_k(df).collect())) == sorted(wanted)
    assert top_k(df.where("false")).count() == 0
    assert top_k(df.where("vec_id % 50 <> 0")).count() == 0


def test_all_letter_pieces_are_loaded():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = language.sentencepiece.SentencePieceProcessor(model_file=path)
    texts = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    assert set(language.load_pieces(path)) == {t for t in texts if t.removeprefix("▁").isalpha()}


def test_words_of_signs_alone_and_letters_set_wide_apart(spark):
    df = spark.createDataFrame([("ass asses sat at the bass glass pass",)] * 50, "text string")
    chances = toxicity.character_chances(df)
    assert toxicity.words_in("@$$", chances) == ["ass"] and toxicity.words_in("@$$!", chances) == ["ass"]
    assert [toxicity.words_in(x, chances) for x in ("$100", "1007", "+1", "!!!", "|||", "455")] == [[]] * 6
    assert toxicity.chunks_of("an i  d\ti\no \u00a0t here") == ["an", "idiot", "here"]


def test_chunks_and_trigrams_equal_their_plain_forms(monkeypatch):
    """Runs of single letters found by lengths, trigrams counted by arrays: as by a pattern and letter by letter."""
    import re

    source = random.Random(5)
    spaced = re.compile(r"(?<!\S)(?:\S\s++){2,}\S(?!\S)")
    texts = ["", " ", "a", "a b", "a b c", " a  b\tc ", "x a b c", "ab c d e\u00a0f gh i j k", "ÄÖ ß! a\x1cb\x1cc", "z" * 50, "İx é. {a b{ it's"]
    texts += ["".join(source.choice("abyzÉß.! \n\t1") for _ in range(source.randrange(60))) for _ in range(500)]
    for text in texts:
        assert toxicity.chunks_of(text) == spaced.sub(lambda found: "".join(found.group().split()), text).split()
    assert toxicity.chunks_of(None) == []
    want = Counter()
    for text in texts:
        for chunk in toxicity.chunks_of(text):
            word = chunk.lower().translate(toxicity.PLAIN).strip(".,;:!?")
            if word.isascii() and word.isalpha():
                codes = [26, 26, *(ord(c) - 97 for c in word), 26]
                want.update((a * 27 + b) * 27 + c for a, b, c in zip(codes, codes[1:], codes[2:]))
    for most in (1, 10, 1 << 20):
        monkeypatch.setattr(toxicity, "COUNTED_LETTERS", most)
        batch = pa.RecordBatch.from_arrays([pa.array([*texts, None])], names=["text"])
        (found,) = toxicity._trigrams(iter([batch]))
        assert dict(zip(*(column.to_pylist() for column in found.columns))) == want
