"""Byte-level BPE and packing against the public libraries, and packing's own invariants."""

from __future__ import annotations

import os
import random
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from zonecast.llm import common
from zonecast.llm.bpe import _Chunks, CHUNK, bpe_decode, bpe_encode, fold_merges, fold_words, load_ranks
from zonecast.llm.near_duplicates import jaccard_components
from zonecast.llm.packing import _Chunks as _Words
from zonecast.llm.packing import _cut, _cut_all, _tokenized, pack, pack_histogram, pattern_slots
from zonecast.llm.queries import word_vocabulary

TEXTS = [
    None, "", " ", "\n\n  a", "It's  the end\t of we'll", "naïve Straße ÉÈ", "漢字かな 한국", "a\x1cb\x1f c", "x" * 5_000, " " * 3_000 + "y",
    "é İstanbul ΟΔΟΣ", "<|endoftext|> <|startoftext|>", "a|b | c||", "3.14 ½ ²", "  z", "Word, WORD; word!? 'tis", "🙂🙃",
    "".join(random.Random(1).choices("abcdefgh", k=3_000)),
]


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encode_and_decode(spark, ranks, library):
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate([*TEXTS, "twice", "twice"])], "doc_id long, text string, ids int")
    got = bpe_decode(bpe_encode(df, ranks, public_tokenizers.PATTERN), ranks).collect()
    texts = dict(enumerate([*TEXTS, "twice", "twice"]))
    for row in got:
        assert row["ids"] == library.encode_ordinary(texts[row["doc_id"]] or "")
        assert bytes(row["decoded"]).decode() == (texts[row["doc_id"]] or "")
    assert len(got) == len(texts)
    assert bpe_encode(df.where("false"), ranks, public_tokenizers.PATTERN).count() == 0


def test_words_fold_as_an_expression(spark, ranks):
    words = [" the", "Straße", "x", "abcabcabc", " 漢字", "unbelievably", "🙂"]
    got = fold_words(spark.createDataFrame([(w,) for w in words], "word string"), ranks).collect()
    assert {r["word"]: r["ids"] for r in got} == {w: fold_merges(w.encode(), ranks) for w in words}


@given(st.text(max_size=80))
@settings(max_examples=200, deadline=None)
def test_any_text(ranks, library, text):
    chunks = _Chunks(ranks, public_tokenizers.PATTERN)
    ids = [i for chunk in CHUNK.findall(text) for i in np.frombuffer(chunks[chunk], np.int32).tolist()]
    assert ids == library.encode_ordinary(text)


def test_long_words_fold_as_short_ones(ranks):
    word = ("abcab" * 60).encode()
    assert len(word) >= 256
    assert fold_merges(word, ranks) == tiktoken.Encoding(
        "own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary(word.decode())


@given(st.text(max_size=80))
@settings(max_examples=150, deadline=None)
def test_any_words(text):
    words = _Words(word_vocabulary()) if not hasattr(test_any_words, "held") else test_any_words.held
    test_any_words.held = words
    cut = _cut(text)
    words.learn(cut)
    ids = [i for chunk in cut for i in np.frombuffer(words[chunk], np.uint32).tolist()]
    assert ids == words.tokenizer.encode(text, add_special_tokens=False).ids


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
@settings(max_examples=100, deadline=None)
def test_patterns_hold_every_piece_once(histogram):
    patterns = pack_histogram(histogram, 64)
    assert all(sum(pattern) <= 64 for _, pattern in patterns)
    held = {}
    for count, pattern in patterns:
        for length in pattern:
            held[length] = held.get(length, 0) + count
    assert held == histogram
    for length, first, last, *_ in pattern_slots(patterns):
        assert 0 <= first <= last < histogram[length]


def test_pack(spark):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    texts = [*TEXTS, "same text"] + ["same text"] * 50 + ["a b c"] * 20
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, length int").repartition(3)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = pack(df, word_vocabulary(), sequence=64).collect()
    wanted = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    found = {i: [] for i in wanted}
    for row in sorted(got, key=lambda r: (r["doc_id"], r["start"])):
        ids = np.frombuffer(row["ids"], np.uint32).tolist()
        assert row["start"] == len(found[row["doc_id"]]) and row["length"] == len(ids) <= 64
        assert row["doc_tokens"] == len(wanted[row["doc_id"]])
        found[row["doc_id"]] += ids
    assert found == wanted
    filled = {}
    for row in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert row["offset"] == filled.get(row["sequence_id"], 0)
        filled[row["sequence_id"]] = row["offset"] + row["length"]
    assert max(filled.values()) <= 64 and sorted(filled) == list(range(len(filled)))
    assert pack(df.where("false"), word_vocabulary()).count() == 0


def test_texts_of_a_batch_share_their_chunks():
    words = _Words(word_vocabulary())
    texts = [*TEXTS, None, "", " \t ", " a\x1cb  c ", "İstanbul Straße,", "a|b | c", "Once once ONCE, once!", "x" * 3000]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for some in (texts, [text for text in texts if "\x1c" not in (text or "")], texts[::-1]):
        raw, bounds = _tokenized(pa.array(some), words, 1)
        ids = np.frombuffer(raw, np.uint32).tolist()
        got = [ids[low:high] for low, high in pairwise(bounds)]
        assert got == [plain.encode(text or "", add_special_tokens=False).ids + [1] for text in some]
    # Rare words cost one call of the tokenizer for many of them, none for each.
    calls = []
    words.words.model = type("Counted", (), {"tokenize": lambda self, word: calls.append(word)})()
    _tokenized(pa.array(["onceer twiceer, thriceer.", "fourthly onceer"]), words, 1)
    assert not calls


@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
@settings(max_examples=200, deadline=None)
def test_texts_are_cut_as_one_by_one(text):
    assert [[chunk for chunk in cut if chunk] for cut in _cut_all(pa.array([text, "a b"])).to_pylist()] == [_cut(text), ["a", "b"]]


def test_a_worker_keeps_the_cache_of_one_operator():
    from zonecast.llm import common, near_duplicates, packing

    common.held("before", None, list)
    first = packing._chunks(word_vocabulary())
    assert packing._chunks(word_vocabulary()) is first and len(common._HELD) == 1
    near_duplicates.shingle_set("one two three four five six")
    assert list(common._HELD) == ["shingles"]
    common.only(None)
    assert not common._HELD


def test_whole_texts_reach_workers_a_slice_at_a_time(spark, monkeypatch):
    """Packing and the shingles ask for batches no larger than what they work on, and leave the session as it was."""
    before, seen = spark.conf.get(common.BATCH_KEY), {}

    def counted(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["many"])

    def watched(df, label, stage=common.stage):
        many = common.map_batches(spark.range(1200, numPartitions=1).toDF("id"), counted, "many long")
        seen.setdefault(label, max(row["many"] for row in stage(many, "many").collect()))
        return stage(df, label)

    monkeypatch.setattr(common, "stage", watched)
    rows = spark.createDataFrame([(i, f"one two three four five six {i}") for i in range(3)], "doc_id long, text string")
    assert pack(rows, word_vocabulary()).count() == 3
    assert jaccard_components(rows).count() == 3
    assert seen["llm-pieces"] == seen["llm-sets"] == seen["llm-hub-sets"] == common.SLICE_ROWS
    assert seen["llm-piece-counts"] == 1200 and spark.conf.get(common.BATCH_KEY) == before
