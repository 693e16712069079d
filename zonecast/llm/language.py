"""Language ID by unigrams over a fixed vocabulary of pieces, summed over all segmentations.

A word's probability in a language is the sum over every way to cut it into pieces of the vocabulary
of the product of their probabilities. One round of expectation-maximisation from equal piece
probabilities, over the counts of all words of all labelled texts, gives the piece probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import map_batches, picked

START = "▁"
SMOOTHING = 0.05
STRANGE = 1e-7
COUNTED_WORDS = 200_000
SCORED_WORDS = 400_000
NOTHING = "und"
WORD = re.compile(r"[^\W\d_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def load_pieces(path: str) -> list[str]:
    """The vocabulary's pieces of letters, some with the mark of a word's start, in lower case."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()))
    return sorted({text for text in texts if text.removeprefix(START).isalpha()})


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _codes(words: list[str]) -> np.ndarray:
    """Code points, one row for each of several words of the same length, with the start mark."""
    joined = "".join(START + word for word in words)
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


class Lattice:
    """Finds the pieces that lie at every place of many words at once."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=1)
        hashes = np.zeros(len(pieces), np.uint64)
        with np.errstate(over="ignore"):
            for i, piece in enumerate(pieces):
                for code in piece:
                    hashes[i] = hashes[i] * BASE + np.uint64(ord(code))
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.strange = len(pieces)

    def spans(self, codes: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """Per (start, end): the words with a piece there, and the pieces. A letter always is one."""
        found = {}
        length = codes.shape[1]
        with np.errstate(over="ignore"):
            for start in range(length):
                hashed = np.zeros(len(codes), np.uint64)
                for end in range(start + 1, min(length, start + self.longest) + 1):
                    hashed = hashed * BASE + codes[:, end - 1]
                    at = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
                    known = self.hashes[at] == hashed
                    if end == start + 1:
                        found[start, end] = np.arange(len(codes)), np.where(known, self.order[at], self.strange)
                    elif known.any():
                        rows = np.flatnonzero(known)
                        found[start, end] = rows, self.order[at[rows]]
        return found


def _by_length(words: list[str], most: int = 4096) -> Iterator[np.ndarray]:
    lengths = np.array([len(word) for word in words])
    order = np.argsort(lengths, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        for low in range(0, len(same), most):
            yield same[low : low + most]


def expected_counts(words: list[str], weights: np.ndarray, lattice: Lattice, chance: np.ndarray) -> np.ndarray:
    """Expected piece counts under ``chance``: pieces x columns of ``weights`` (words x languages).

    Sums over the start and end of a word are rescaled at every letter, so long words stay finite.
    """
    counts = np.zeros((lattice.strange + 1, weights.shape[1]))
    for rows in _by_length(words):
        codes = _codes([words[i] for i in rows])
        spans, (n, length) = lattice.spans(codes), codes.shape
        ahead, scale = np.zeros((length + 1, n)), np.ones((length + 1, n))
        ahead[0] = 1
        into: list[list[tuple[int, int]]] = [[] for _ in range(length + 1)]
        for span in spans:
            into[span[1]].append(span)
        for end in range(1, length + 1):
            for start, _ in into[end]:
                at, piece = spans[start, end]
                part = ahead[start, at] * chance[piece]
                for between in range(start + 1, end):
                    part /= scale[between, at]
                ahead[end, at] += part
            scale[end] = ahead[end]
            ahead[end] = 1
        back = np.zeros((length + 1, n))
        back[length] = 1
        for end in range(length, 0, -1):
            for start, _ in into[end]:
                at, piece = spans[start, end]
                part = chance[piece] * back[end, at]
                for between in range(start + 1, end + 1):
                    part /= scale[between, at]
                back[start, at] += part
                np.add.at(counts, piece, part[:, None] * weights[rows[at]])
    return counts


def log_chances(words: list[str], lattice: Lattice, chances: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, by the forward algorithm."""
    result = np.zeros((len(words), chances.shape[1]))
    for rows in _by_length(words):
        codes = _codes([words[i] for i in rows])
        spans, (n, length) = lattice.spans(codes), codes.shape
        window = [np.ones((n, chances.shape[1]))]
        total = np.zeros((n, chances.shape[1]))
        for end in range(1, length + 1):
            ahead = np.zeros((n, chances.shape[1]))
            for start in range(max(0, end - lattice.longest), end):
                if (start, end) in spans:
                    at, piece = spans[start, end]
                    ahead[at] += window[start - end][at] * chances[piece]
            total += np.log(ahead)
            window = [past / ahead for past in window[1 - lattice.longest :]] if lattice.longest > 1 else []
            window.append(np.ones_like(ahead))
        result[rows] = total
    return result


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[str]
    chances: np.ndarray  # pieces and, last, strange letters x languages
    priors: np.ndarray


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[tuple[str, str]] = Counter()

    def out():
        langs, words = zip(*counts, strict=True)
        columns = [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())]
        yield from pa.table(columns, names=["lang", "word", "many"]).to_batches(max_chunksize=20_000)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for word in words_of(text):
                counts[lang, word] += 1
            if len(counts) > COUNTED_WORDS:
                yield from out()
                counts.clear()
    if counts:
        yield from out()


def fit_languages(
    df: DataFrame, pieces: list[str], text: str = "text", lang: str = "lang", smoothing: float = SMOOTHING
) -> LanguageModel:
    """Piece probabilities per language from all rows of ``df`` with a language.

    Null and empty texts have no words but count for their language's share; an empty table, or one
    without languages, gives a model that knows none. Repeated rows count each time. A word of any
    length takes time in proportion to it. Words are counted in every task and summed per word, so copies and frequent words are settled
    before the shuffle. What comes to the driver is one number per piece and language.
    """
    spark = df.sparkSession
    rows = picked(df, lang=lang, text=text).where("lang is not null")
    numbers = {row["lang"]: row["many"] for row in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("many")).collect()}
    languages = sorted(numbers)
    if not languages:
        return LanguageModel([], pieces, np.zeros((len(pieces) + 1, 0)), np.zeros(0))
    shared = spark.sparkContext.broadcast((pieces, languages))
    counted = map_batches(rows, _word_counts, "lang string, word string, many long")
    words = counted.groupBy("word", "lang").agg(F.sum("many").alias("many"))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, names = shared.value
        lattice, place = Lattice(own), {name: i for i, name in enumerate(names)}
        even = np.full(len(own) + 1, 1 / len(own))
        even[-1] = STRANGE
        counts = np.zeros((len(own) + 1, len(names)))
        for batch in batches:
            weights = np.zeros((len(batch), len(names)))
            column = [place[name] for name in batch.column(1).to_pylist()]
            weights[np.arange(len(batch)), column] = batch.column(2).to_numpy()
            counts += expected_counts(batch.column(0).to_pylist(), weights, lattice, even)
        piece, language = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece, pa.int32()), pa.array(language, pa.int32()), pa.array(counts[piece, language])],
            names=["piece", "language", "expected"],
        )

    expected = map_batches(words, expect, "piece int, language int, expected double")
    sums = np.zeros((len(pieces) + 1, len(languages)))
    for row in expected.groupBy("piece", "language").agg(F.sum("expected").alias("expected")).collect():
        sums[row["piece"], row["language"]] = row["expected"]
    chances = (sums + smoothing) / (sums + smoothing).sum(axis=0)
    priors = np.array([numbers[name] for name in languages], float)
    return LanguageModel(languages, pieces, chances, priors / priors.sum())


def predict_language(df: DataFrame, model: LanguageModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score, the model's probability of that language.

    A text that is null or has no letter gets 'und' and 0, as does every text if nothing was
    learned; of equally likely languages the first by name is taken. Rows are independent, so
    repeated rows and ids, null ids, other columns and the length of a text change nothing.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = picked(df, id=id, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        lattice = Lattice(own.pieces)
        places: dict[str, int] = {}
        logs = np.zeros((0, len(own.languages)))

        def scored(words: list[str]) -> np.ndarray:
            nonlocal logs
            if len(places) > SCORED_WORDS:
                places.clear()
                logs = logs[:0]
            new = [word for word in dict.fromkeys(words) if word not in places]
            if new:
                if len(places) + len(new) > len(logs):
                    logs = np.concatenate([logs, np.zeros((max(len(new), len(logs) // 2), len(own.languages)))])
                logs[len(places) : len(places) + len(new)] = log_chances(new, lattice, own.chances)
                places.update(zip(new, range(len(places), len(places) + len(new)), strict=True))
            return logs[np.fromiter(map(places.__getitem__, words), np.int64, len(words))]

        for batch in batches:
            texts = batch.column(1).to_pylist()
            names, scores = [], []
            for low in range(0, len(texts), 128):
                cut = [words_of(t) for t in texts[low : low + 128]]
                if own.languages:
                    flat = [word for found in cut for word in found]
                    ends = np.cumsum([len(found) for found in cut])
                    sums = np.concatenate([np.zeros((1, len(own.languages))), np.cumsum(scored(flat), axis=0)])
                    likely = np.diff(sums[np.concatenate([[0], ends])], axis=0) + np.log(own.priors)
                    likely = np.exp(likely - likely.max(axis=1, keepdims=True))
                    likely /= likely.sum(axis=1, keepdims=True)
                    best = likely.argmax(axis=1)
                for i, found in enumerate(cut):
                    letters = any(any(map(str.isalpha, word)) for word in found) and bool(own.languages)
                    names.append(own.languages[best[i]] if letters else NOTHING)
                    scores.append(float(likely[i, best[i]]) if letters else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["id", "lang_pred", "score"],
            )

    id_type = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, run, f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id)
