"""Toxicity behind disguises: a noisy channel restores words, a learned lexicon scores them.

Digits and signs that stand for letters, letters set apart and letters drawn out make a lattice of
readings; the Viterbi path under a character model of the corpus is the restored word. Words and
beginnings of words that toxic texts use more often carry weights; a text's weights and length give
its score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import Remembered, give_back, map_batches, only, picked, sliced_batches, staged, staged_texts

SAMPLE = 8_000  # labelled rows the lexicon and the final weights are learned from
LEXICON = 3_000  # words and beginnings that carry a weight
LEAST_TEXTS = 3  # toxic texts of the sample that must use one
BEGINNINGS = range(3, 9)
CACHED_CHUNKS = 300_000
COUNTED_CHUNKS = 100_000
COUNTED_LETTERS = 1 << 18
COUNTED_MARKS = 100_000

# What letters the signs of disguised writing stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e",
}
SWAP, DROP, SHORTEN = math.log(0.3), math.log(0.05), math.log(0.3)
EDGE = 26  # code of a word's start and end; letters are 0 to 25


def _plain_letters() -> dict[int, str]:
    """Latin letters with marks to the letters without them."""
    found = {}
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFKD", chr(code)).lower()
        letters = "".join(c for c in base if "a" <= c <= "z")
        if letters:
            found[code] = letters
    return found | {ord("ß"): "ss", ord("æ"): "ae", ord("Æ"): "ae", ord("ø"): "o", ord("Ø"): "o"}


PLAIN = _plain_letters()
SIGNS = re.compile("[" + re.escape("".join(LEET)) + "]{3,}")
NUMBER = re.compile(r"[$€+|!]*\d+[$€+|!]*")
PARTS = re.compile(r"[^\w@$!|+€]+|_+")
DRAWN = re.compile(r"(.)\1\1")
TRAILING = re.compile(r"[!?.,;:]+$|([^\w\s])\1+$")


def chunks_of(text: str | None) -> list[str]:
    """White-space chunks; three or more letters set apart by white space are one chunk."""
    chunks = (text or "").split()
    lengths = list(map(len, chunks))
    if lengths.count(1) < 3:
        return chunks
    single = bytes(map((1).__eq__, lengths))
    found, done, at = [], 0, single.find(b"\1\1\1")
    while at >= 0:
        end = single.find(b"\0", at)
        end = len(chunks) if end < 0 else end
        found += [*chunks[done:at], "".join(chunks[at:end])]
        done, at = end, single.find(b"\1\1\1", end)
    return found + chunks[done:]


def restored(observed: str, chances: np.ndarray) -> str:
    """The likeliest word behind ``observed``, lower case, by the Viterbi algorithm.

    States are the last two letters read. ``chances``: log probability of a letter after two others.
    A state points back to the one it came from, so the time is in proportion to the length. Of
    equally likely ways into a state the first stays.
    """
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(EDGE, EDGE): (0.0, None)}
    for i, sign in enumerate(observed):
        options = []
        if "a" <= sign <= "z":
            options.append((ord(sign) - 97, 0.0))
            if i > 0 and observed[i - 1] == sign:
                options.append((None, SHORTEN))
        else:
            options += [(ord(letter) - 97, SWAP) for letter in LEET.get(sign, "")]
            options.append((None, DROP))
        reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, way) in states.items():
            for letter, cost in options:
                key, total = ((a, b), score + cost) if letter is None else ((b, letter), score + cost + chances[a, b, letter])
                if key not in reached or reached[key][0] < total:
                    reached[key] = total, way if letter is None else (way, letter)
        states = reached
    way = max(((score + chances[a, b, EDGE], way) for (a, b), (score, way) in states.items()), key=lambda end: end[0])[1]
    letters = []
    while way is not None:
        way, letter = way
        letters.append(chr(97 + letter))
    return "".join(reversed(letters))


def words_in(chunk: str, chances: np.ndarray) -> list[str]:
    """The words of a chunk without marks, restored where they are disguised.

    Chunks of signs alone are read too, but not digits that nothing but marks of sums surround.
    """
    plain = chunk.lower()
    if plain.isalpha() and not DRAWN.search(plain):
        return [plain]
    signs = plain.rstrip("!?.,;:")
    if SIGNS.fullmatch(signs) and len(set(signs)) > 1 and not NUMBER.fullmatch(signs):
        return [word for word in [restored(signs, chances)] if word]
    parts = [part for part in PARTS.split(TRAILING.sub("", plain)) if part]
    if len(parts) >= 3 and all(len(part) == 1 for part in parts):
        parts = ["".join(parts)]
    found = []
    for part in parts:
        if part.isalpha() and not DRAWN.search(part):
            found.append(part)
        elif any(map(str.isalpha, part)):
            found.append(restored(part.translate(PLAIN), chances))
    return [word for word in found if word]


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(27**3)
    counts: Counter[str] = Counter()

    def add(words: list[str], many: list[int]) -> None:
        # Two edges, the word, one edge: the code after z stands for an edge.
        codes = np.frombuffer(("{{" + "{{{".join(words) + "{").encode(), np.uint8).astype(np.int32) - 97
        first, second, third = codes[:-2], codes[1:-1], codes[2:]
        within = (second != EDGE) | (third != EDGE)  # all others reach from one word into the next
        weights = np.repeat(np.array(many, float), np.array(list(map(len, words))) + 3)[:-2]
        total[:] += np.bincount(((first * 27 + second) * 27 + third)[within], weights[within], 27**3)

    def settle() -> None:
        words, many, letters = [], [], 0
        for chunk, uses in counts.items():
            word = chunk.lower()
            word = (word if word.isascii() else word.translate(PLAIN)).strip(".,;:!?")
            if word.isascii() and word.isalpha():
                words.append(word)
                many.append(uses)
                letters += len(word)
                if letters > COUNTED_LETTERS:
                    add(words, many)
                    words, many, letters = [], [], 0
        if words:
            add(words, many)
        counts.clear()

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(chunks_of(text))
            if len(counts) > COUNTED_CHUNKS:
                settle()
    settle()
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["trigram", "many"])


def character_chances(df: DataFrame, text: str = "text") -> np.ndarray:
    """Log probability of a letter (or a word's end) after two letters, from all texts of ``df``."""
    counted = map_batches(picked(df, text=text), _trigrams, "trigram long, many double")
    counts = np.zeros(27**3)
    with sliced_batches(df.sparkSession):
        found = counted.groupBy("trigram").agg(F.sum("many").alias("many")).collect()
    for row in found:
        counts[row["trigram"]] = row["many"]
    counts = counts.reshape(27, 27, 27) + 0.01
    single = counts.sum(axis=(0, 1)) / counts.sum()
    return np.log(0.95 * counts / counts.sum(axis=2, keepdims=True) + 0.05 * single)


def _marks(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in BEGINNINGS if n <= len(word))]


@dataclass
class ToxicityModel:
    chances: np.ndarray
    lexicon: dict[str, tuple[float, float]] = field(default_factory=dict)  # mark: gain, weight
    final: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def weight(self, word: str) -> float:
        """Weight of the mark that explains most of the toxic texts of the sample; the longest of several."""
        found = [(*self.lexicon[mark], len(mark)) for mark in _marks(word) if mark in self.lexicon]
        return max(found, key=lambda x: (x[0], x[2]))[1] if found else 0.0


class _Weights(Remembered):
    """Chunk to the sum of its words' weights."""

    def __init__(self, model: ToxicityModel):
        super().__init__(CACHED_CHUNKS)
        self.model = model

    def make(self, chunk: str) -> float:
        return sum(map(self.model.weight, words_in(chunk, self.model.chances)))


def _evidence(text: str | None, weights: _Weights) -> tuple[float, float, float, float]:
    """Inputs of the final weights: one, weight and hits against the length, and the length.

    Distinct chunks count once, so repeated lines do not thin out what else a text says.
    """
    found = list(map(weights.__getitem__, set(chunks_of(text))))
    spread = math.sqrt(1 + 0.02 * len(found))
    return 1.0, min(40.0, sum(found) / spread), spread, min(40.0, (len(found) - found.count(0.0)) / spread**2)


def _logistic(inputs: np.ndarray, labels: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of a penalised logistic regression, by Newton steps."""
    weights = np.zeros(inputs.shape[1])
    keep = np.eye(inputs.shape[1]) * penalty
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (labels - chance) - penalty * weights
        bend = (inputs * (chance * (1 - chance))[:, None]).T @ inputs + keep
        weights = weights + np.linalg.solve(bend, slope)
    return weights


def _lexicon(cases: DataFrame, chances: np.ndarray, most: int) -> dict[str, tuple[float, float]]:
    """Marks that toxic texts use more than others, with their gain and weight (log ratio of rates)."""
    shared = cases.sparkSession.sparkContext.broadcast(chances)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])

        def settle() -> Iterator[pa.RecordBatch]:
            columns = zip(*sums.values(), strict=True) if sums else ((), (), ())
            arrays = [pa.array(list(sums), pa.string()), *(pa.array(column, pa.int64()) for column in columns)]
            sums.clear()
            yield from pa.table(arrays, names=["mark", "used", "clean", "texts"]).to_batches(max_chunksize=20_000)

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = Counter(word for chunk in chunks_of(text) for word in words_in(chunk, shared.value))
                marks: Counter[str] = Counter({"": sum(words.values())})
                for word, many in words.items():
                    for mark in _marks(word):
                        marks[mark] += many
                for mark, many in marks.items():
                    held = sums[mark]
                    held[0 if toxic else 1] += many
                    held[2] += toxic
                if len(sums) > COUNTED_MARKS:
                    yield from settle()
        yield from settle()

    counted = staged_texts(map_batches(cases.select("text", "toxic"), count, "mark string, used long, clean long, texts long"), "marks")
    sums = staged(counted.groupBy("mark").agg(*[F.sum(name).alias(name) for name in ("used", "clean", "texts")]), "mark-sums")
    whole = sums.where("mark = ''").first()
    if whole is None or not whole["used"] or not whole["clean"]:
        return {}
    ratio = F.log((F.col("used") + 0.5) / (F.col("clean") + 0.5)) + math.log((whole["clean"] + 1) / (whole["used"] + 1))
    best = (
        sums.where((F.col("mark") != "") & (F.col("texts") >= LEAST_TEXTS)).withColumn("weight", ratio).where("weight > 2")
        .withColumn("gain", F.col("texts") * F.col("weight")).orderBy(F.desc("gain"), "mark").limit(most).collect()
    )
    return {row["mark"]: (row["gain"], row["weight"]) for row in best}


def fit_toxicity(
    df: DataFrame, labels: DataFrame, learn: Column, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, at: float = 0.7,
    lexicon: int = LEXICON,
) -> ToxicityModel:
    """Learn from the texts of ``df`` and at most ``sample`` of the ``labels`` whose id meets ``learn``.

    The character model reads all texts. Of labelled ids those first by a hash are taken, so the
    choice is the same however the table is stored; of repeated ids the greatest label counts. The
    final weights are learned on each half of them with a lexicon of the other half, the lexicon in
    use on all; it holds the ``lexicon`` marks of greatest gain. The score ``at`` is put where calling a text toxic from there on gives the best F1.
    Without labels every score is 0.5.
    """
    model = ToxicityModel(character_chances(df, text))
    known = labels.where(learn & F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(
        F.max(label).cast("int").alias("toxic")
    )
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample).withColumn("half", F.xxhash64("id", F.lit(7)) % 2 == 0)
    cases = staged(picked(df, id=id, text=text).join(F.broadcast(chosen), "id"), "labelled")
    found = []
    for half in (F.col("half"), ~F.col("half")):
        partial = ToxicityModel(model.chances, _lexicon(cases.where(half), model.chances, lexicon))
        found += _inputs(cases.where(~half), partial)
    model.lexicon = _lexicon(cases, model.chances, lexicon)
    if found:
        inputs, toxic = np.array([row["inputs"] for row in found]), np.array([row["toxic"] for row in found], float)
        model.final = _logistic(inputs, toxic)
        model.final[0] += math.log(at / (1 - at)) - _best_cut(inputs @ model.final, toxic)
    return model


def _best_cut(values: np.ndarray, labels: np.ndarray) -> float:
    """The value from which calling a case positive gives the greatest F1."""
    order = np.argsort(-values, kind="stable")
    hits = np.cumsum(labels[order])
    score = 2 * hits / (np.arange(1, len(values) + 1) + labels.sum())
    best = int(score.argmax())
    beyond = values[order[min(best + 1, len(values) - 1)]]
    return float((values[order[best]] + beyond) / 2)


def _inputs(cases: DataFrame, model: ToxicityModel) -> list:
    """Inputs of the final weights and labels of the sample; the caller bounds its size."""
    shared = cases.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(shared.value)
        for batch in batches:
            rows = [_evidence(text, weights) for text in batch.column(0).to_pylist()]
            values = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([values, batch.column(1)], names=["inputs", "toxic"])

    with sliced_batches(cases.sparkSession):
        return map_batches(cases.select("text", "toxic"), run, "inputs array<double>, toxic int").collect()


def with_toxicity(df: DataFrame, model: ToxicityModel, score: str = "score", text: str = "text") -> DataFrame:
    """``df`` with a column ``score`` from 0 to 1.

    Texts reach a worker in batches of the session's size; within :func:`sliced_batches` few stand in memory at once.
    A null text scores as an empty one. Rows are independent: repeated rows and ids, null ids, other
    columns and the length of a text change nothing; an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        only(None)
        weights = _Weights(shared.value)
        for batch in texts:
            inputs = np.array([_evidence(text, weights) for text in batch]).reshape(-1, 4)
            yield pd.Series(1 / (1 + np.exp(-np.clip(inputs @ shared.value.final, -30, 30))))
        del weights
        give_back()

    return df.withColumn(score, scored(F.col(f"`{text}`")))


def toxicity(df: DataFrame, model: ToxicityModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: id, score from 0 to 1, as :func:`with_toxicity` gives it."""
    rows = picked(df, id=id, text=text)
    return staged_texts(with_toxicity(rows, model).select("id", "score"), "toxicity").withColumnRenamed("id", id)
