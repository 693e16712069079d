"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad, by features of its own and of its neighbours and by the labels next to
it. A document's quality is the mean of its lines' chances of being good, weighted by their length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import map_batches, picked, staged

SAMPLE = 6_000  # labelled rows the field and the final weights are learned from
TOGETHER = 128
TRANSITION_ROUNDS = 4
OTHER = 0x250
UPPER, LOWER, DIGIT, SPACE, BAR, SIGN, STOP = range(7)


def _classes() -> np.ndarray:
    """The class of every code point below ``OTHER``; the last entry is for all beyond."""
    found = np.full(OTHER + 1, SIGN, np.uint8)
    for code in range(OTHER):
        c = chr(code)
        kinds = ((c.isupper(), UPPER), (c.isalpha(), LOWER), (c.isdigit(), DIGIT), (c.isspace(), SPACE), (c == "|", BAR), (c in ".,;:'\"", STOP))
        found[code] = next((kind for held, kind in kinds if held), SIGN)
    found[OTHER] = LOWER
    return found


CLASSES = _classes()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of all lines of the texts, the lines' lengths, and how many lines each text has."""
    lines = [line for text in texts for line in text.split("\n")]
    counts = np.array([text.count("\n") + 1 for text in texts], np.int64)
    lengths = np.array([len(line) for line in lines], np.int64)
    codes = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = CLASSES[np.minimum(codes, OTHER)]
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    kinds = np.append(kinds, np.uint8(255))  # the end of the last line
    shares = [np.add.reduceat(kinds == kind, starts) for kind in (UPPER, LOWER, DIGIT, BAR, SIGN, STOP)]
    upper, lower, digit, bar, sign, stop = (share / np.maximum(lengths, 1) for share in shares)
    split = [line.split() for line in lines]
    words = np.array([len(found) for found in split])
    distinct = np.array([len(set(found)) for found in split])
    again = 1 - distinct / np.maximum(words, 1)
    letters = np.maximum(shares[0] + shares[1], 1)
    own = np.stack(
        [
            shares[0] / letters, lower, digit, np.minimum(bar * 10, 1), np.minimum(sign * 4, 1), np.minimum(stop * 10, 1),
            again * np.minimum(words / 8, 1), np.log1p(words) / 4, np.minimum(lengths / np.maximum(words, 1) / 12, 1), (lengths == 0) * 1.0,
        ],
        axis=1,
    )
    return own, lengths, counts


def chain_features(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A one, a line's own features, and those of the line before and after in its text (else zero)."""
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[first + counts - 1] = 0, 0
    return np.concatenate([np.ones((len(own), 1)), own, before, after], axis=1)


def marginals(emissions: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of each line to be good, and expected numbers of label pairs, by forward-backward.

    ``emissions``: log-odds of good for all lines, text by text. Texts of similar length go together.
    """
    chance, pairs = np.zeros(len(emissions)), np.zeros((2, 2))
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    size = np.ceil(np.log2(np.maximum(counts, 1))).astype(int)
    for group in range(size.max(initial=0) + 1):
        rows = np.flatnonzero(size == group)
        if not len(rows):
            continue
        most = int(counts[rows].max())
        held = np.arange(most)[None, :] < counts[rows, None]
        at = np.where(held, first[rows, None] + np.arange(most), first[rows, None])
        odds = np.clip(emissions[at], -30, 30)
        potential = np.stack([np.ones_like(odds), np.exp(odds)], axis=2) / (1 + np.exp(odds))[:, :, None]
        potential[~held] = 1
        ahead, back = np.zeros((len(rows), most, 2)), np.ones((len(rows), most, 2))
        state = np.full((len(rows), 2), 0.5)
        for t in range(most):
            state = (state if t == 0 else state @ transitions) * potential[:, t]
            state = state / state.sum(axis=1, keepdims=True)
            ahead[:, t] = state
        for t in range(most - 2, -1, -1):
            state = (back[:, t + 1] * potential[:, t + 1]) @ transitions.T
            state = np.where(held[:, t + 1, None], state / state.sum(axis=1, keepdims=True), 1.0)
            back[:, t] = state
        both = ahead * back
        both /= both.sum(axis=2, keepdims=True)
        chance[at[held]] = both[held][:, 1]
        if most > 1:
            joint = ahead[:, :-1, :, None] * transitions * (potential * back)[:, 1:, None, :]
            joint /= joint.sum(axis=(2, 3), keepdims=True)
            pairs += joint[held[:, 1:]].sum(axis=0)
    return chance, pairs


def _logistic(inputs: np.ndarray, labels: np.ndarray, cases: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of a penalised logistic regression with case weights, by Newton steps."""
    weights = np.zeros(inputs.shape[1])
    for _ in range(20):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (cases * (labels - chance)) - penalty * weights
        bend = (inputs * (cases * chance * (1 - chance))[:, None]).T @ inputs + penalty * np.eye(len(weights))
        weights = weights + np.linalg.solve(bend, slope)
    return weights


@dataclass
class QualityModel:
    emissions: np.ndarray | None = None
    transitions: np.ndarray = field(default_factory=lambda: np.full((2, 2), 0.5))
    final: tuple[float, float] = (0.0, 0.0)

    def raw(self, own: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log-odds of the length-weighted mean chance of good lines; lines count one more than their length."""
        chance, _ = marginals(chain_features(own, counts) @ self.emissions, counts, self.transitions)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        mean = np.add.reduceat(chance * (lengths + 1), first) / np.add.reduceat(lengths + 1, first)
        mean = np.clip(mean, 1e-4, 1 - 1e-4)
        return np.log(mean / (1 - mean))

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.emissions is None:
            return np.full(len(texts), 0.5)
        parts = [line_features(texts[i : i + TOGETHER]) for i in range(0, len(texts), TOGETHER)]
        own, lengths, counts = (np.concatenate([part[k] for part in parts]) for k in range(3))
        slope, shift = self.final
        return 1 / (1 + np.exp(-np.clip(slope * self.raw(own, lengths, counts) + shift, -30, 30)))


def _worst_cut(values: np.ndarray, labels: np.ndarray) -> float:
    """The value below which calling a case bad gives the greatest F1 of the bad ones."""
    order = np.argsort(values, kind="stable")
    hits = np.cumsum(1 - labels[order])
    best = int((2 * hits / (np.arange(1, len(values) + 1) + (1 - labels).sum())).argmax())
    return float((values[order[best]] + values[order[min(best + 1, len(values) - 1)]]) / 2)


def fit_quality(
    df: DataFrame, labels: DataFrame, learn: Column, id: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE, at: float = 0.3,
) -> QualityModel:
    """Learn the field from at most ``sample`` labelled texts whose id meets ``learn``.

    Ids are taken in the order of a hash; of repeated ids the least label counts. Tasks turn texts
    into line features, and those of the sample come to the driver. Lines start with their text's
    label: emissions are fitted on them, each text weighing the same, then transitions by expected
    label pairs. The score ``at`` is put where calling texts below it bad gives the best F1. With
    labels of one kind only, or none, every score is 0.5.
    """
    known = labels.where(learn & F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(
        F.min(label).cast("int").alias("label")
    )
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    cases = picked(df, id=id, text=text).join(F.broadcast(chosen), "id").select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, lengths, _ = line_features([text or ""])
                columns = [own.astype("f4").tobytes()], lengths.astype("i4").tobytes(), label
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.binary()), pa.array([columns[1]], pa.binary()), pa.array([label], pa.int32())],
                    names=["own", "lengths", "label"],
                )

    rows = staged(map_batches(cases, run, "own binary, lengths binary, label int"), "quality-sample").collect()
    truth = np.array([row["label"] for row in rows], float)
    model = QualityModel()
    if not 0 < truth.sum() < len(truth):
        return model
    sizes = [np.frombuffer(row["lengths"], np.int32).astype(np.int64) for row in rows]
    counts, lengths = np.array([len(x) for x in sizes]), np.concatenate(sizes)
    own = np.concatenate([np.frombuffer(row["own"], np.float32).reshape(len(n), -1) for row, n in zip(rows, sizes, strict=True)]).astype(float)
    inputs = chain_features(own, counts)
    share = np.repeat(np.where(truth == 1, 0.5 / truth.mean(), 0.5 / (1 - truth.mean())) / counts, counts)
    model.emissions = _logistic(inputs, np.repeat(truth, counts), share)
    model.transitions = np.array([[0.8, 0.2], [0.2, 0.8]])
    for _ in range(TRANSITION_ROUNDS):
        _, pairs = marginals(inputs @ model.emissions, counts, model.transitions)
        model.transitions = (pairs + 1) / (pairs + 1).sum(axis=1, keepdims=True)
    raw = model.raw(own, lengths, counts)
    slope, _ = _logistic(np.stack([raw, np.ones_like(raw)], axis=1), truth, np.ones_like(truth))
    model.final = (float(slope), math.log(at / (1 - at)) - float(slope) * _worst_cut(raw, truth))
    return model


def quality(df: DataFrame, model: QualityModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: id, score from 0 to 1, higher for better texts.

    A null text counts as empty, which is one empty line. Rows are independent: repeated rows and
    ids, null ids, other columns and the length of a text change nothing.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = picked(df, id=id, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores([text or "" for text in batch.column(1).to_pylist()]) if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    id_type = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, run, f"id {id_type}, score double").withColumnRenamed("id", id)
