"""Packing of token sequences: shortest pack first over the histogram of lengths.

The histogram has one entry per length and so fits the driver at any size of the input. It is packed
longest lengths first into counted patterns; documents then find their place by the rank of their
pieces among the pieces of the same length.
"""

from __future__ import annotations

import heapq
import itertools
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import WhitespaceSplit

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import Remembered, held, map_batches, picked, slices, staged, staged_texts
from zonecast.session import small

SEQUENCE = 2048
END = 1
CACHED_CHUNKS = 300_000
TOGETHER = 50
CACHED_TAILS = 10_000
MARKS = ".,;:!?"
# The letters below are Latin; the lower case of the dotted capital I is two code points.
OTHER = re.compile("[\u0130\u0250-\U0010ffff]")
# The code points with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
CHUNK = re.compile(f"[^{WHITE}]+")


def _cut(text: str | None) -> list[str]:
    """The chunks of a text; str.split also cuts at four separators that are not white space."""
    if not text:
        return []
    return CHUNK.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()


def _cut_all(texts: pa.Array) -> pa.ListArray:
    """:func:`_cut` of each text, at times with empty chunks at its ends."""
    if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
        return pa.array(map(_cut, texts.to_pylist()), pa.list_(pa.string()))
    return pc.utf8_split_whitespace(texts)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(byte if byte in own else next(rest)) for byte in range(256)]


class _Words:
    """The ids of words of lower-case letters as bytes, by the tokenizer's merges alone.

    Many words are merged as one text; the token that ends a word is told by its suffix.
    """

    def __init__(self, vocabulary: str):
        model = json.loads(vocabulary)["model"]
        merges = [tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge) for merge in model["merges"]]
        suffix = model["end_of_word_suffix"]
        self.model = BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=suffix, cache_capacity=0)
        self.tokenizer = Tokenizer(self.model)
        self.tokenizer.pre_tokenizer = WhitespaceSplit()
        self.last = np.zeros(1 + max(model["vocab"].values()), bool)
        self.last[[id for token, id in model["vocab"].items() if token.endswith(suffix)]] = True
        self.letters = _byte_letters()

    def spelled(self, word: str) -> str:
        return word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))

    def one(self, word: str) -> bytes:
        return array("I", [token.id for token in self.model.tokenize(word)]).tobytes()

    def encoded(self, words: list[str]) -> list[bytes]:
        found, spelled = [], list(map(self.spelled, words))
        parts = [spelled[i : i + TOGETHER] for i in range(0, len(spelled), TOGETHER)]
        for part, encoded in zip(
            parts, self.tokenizer.encode_batch_fast(list(map(" ".join, parts)), add_special_tokens=False), strict=True
        ):
            ids = np.array(encoded.ids, np.uint32)
            ends = (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
            if len(ends) == len(part):
                raw = ids.tobytes()
                found += [raw[start:end] for start, end in itertools.pairwise([0, *ends])]
            else:  # a vocabulary without some letter
                found += map(self.one, part)
        return found


class _Chunks(Remembered):
    """Chunk without white space to its ids as bytes.

    A Latin word, with or without closing marks, needs the merges only: it is one letter run, whose
    letters have one composed form and one lower case each. All other chunks go through the whole
    tokenizer, many as one text with a bar between them, as no token crosses white space.
    """

    def __init__(self, vocabulary: str):
        super().__init__(CACHED_CHUNKS)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.bar = self.tokenizer.encode("|", add_special_tokens=False).ids[0]
        self.words, self.tails = _Words(vocabulary), {}

    def make(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, np.uint32).tobytes()

    def encoded(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk."""
        found = list(map(self.get, chunks))
        new = [i for i, ids in enumerate(found) if ids is None]
        made = self._made([chunks[i] for i in new])
        for i in new:
            found[i] = made[chunks[i]]
        return found

    def learn(self, chunks: Iterable[str]) -> None:
        """Keep the ids of the ``chunks`` for later ones."""
        self._made(itertools.filterfalse(self.__contains__, set(chunks)))

    def _made(self, chunks: Iterable[str]) -> dict[str, bytes]:
        """The ids of distinct ``chunks`` that are not among the latest."""
        found, others, old, tails = {}, [], self.old, self.tails
        plain, words, ends = [], [], []  # no tuples: many would set off the garbage collector
        for chunk in chunks:
            known = old.get(chunk)
            if known is not None:
                found[chunk] = known
                continue
            word = chunk.rstrip(MARKS)
            if word.isalpha() and (word.isascii() or not OTHER.search(word)):
                plain.append(chunk)
                words.append(word.lower())
                ends.append(chunk[len(word) :])
            elif "|" in chunk:
                found[chunk] = self.make(chunk)
            else:
                others.append(chunk)
        if len(tails) > CACHED_TAILS:
            tails.clear()
        for tail in set(ends).difference(tails):
            tails[tail] = self.make(tail)
        distinct = list(set(words))
        known = dict(zip(distinct, self.words.encoded(distinct), strict=True))
        for chunk, word, tail in zip(plain, words, ends, strict=True):
            found[chunk] = known[word] + tails[tail]
        parts = [others[i : i + TOGETHER] for i in range(0, len(others), TOGETHER)]
        texts = [" | ".join([*part, ""]) for part in parts]
        for part, encoded in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(encoded.ids, np.uint32)
            raw, start = ids.tobytes(), 0
            for chunk, end in zip(part, np.flatnonzero(ids == self.bar).tolist(), strict=True):
                found[chunk] = raw[4 * start : 4 * end]
                start = end + 1
        self.take(found)
        return found


def _chunks(vocabulary: str) -> _Chunks:
    return held("packing", hash(vocabulary), lambda: _Chunks(vocabulary))


def _tokenized(texts: pa.Array, chunks: _Chunks, end: int) -> tuple[bytes, list[int]]:
    """The ids of all texts behind each other, each with ``end`` at its end, and the ids before each text."""
    cut = _cut_all(texts)
    coded = cut.flatten().dictionary_encode()
    encoded = chunks.encoded(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    sizes = np.array([*map(len, encoded), 4]) // 4
    pool = np.frombuffer(b"".join([*encoded, np.array([end], np.uint32).tobytes()]), np.uint32)
    many = np.cumsum(cut.value_lengths().fill_null(0).to_numpy())
    used = np.insert(coded.indices.to_numpy(), many, len(encoded))
    lengths = sizes[used]
    ends = np.cumsum(lengths)
    ids = pool[np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[used] - ends + lengths, lengths)]
    return ids.tobytes(), [0, *ends[many + np.arange(len(many))].tolist()]


def tokenized_pieces(
    df: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, end: int = END
) -> DataFrame:
    """The pieces of every row: id, start, length, ids (32-bit, little-endian), doc_tokens, task, turn.

    A row's ids are those of its text and then ``end``; every ``sequence`` ids make a piece and the
    rest is the last one. ``turn`` counts the pieces of a length within the task that made them.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    rows = picked(df, id=id, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, task = _chunks(shared.value), TaskContext.get().partitionId()
        turns = np.zeros(sequence + 1, np.int64)
        for batch in slices(batches):
            raw, bounds = _tokenized(batch.column(1), chunks, end)
            source, starts, pieces, totals = [], [], [], []
            for row, (low, high) in enumerate(itertools.pairwise(bounds)):
                for start in range(low, high, sequence):
                    source.append(row)
                    starts.append(start - low)
                    pieces.append(raw[4 * start : 4 * min(start + sequence, high)])
                    totals.append(high - low)
            lengths = np.array([len(piece) // 4 for piece in pieces])
            turn = np.empty(len(lengths), np.int64)
            for i, length in enumerate(lengths.tolist()):
                turn[i] = turns[length]
                turns[length] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(source)), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                    pa.array(pieces, pa.binary()), pa.array(totals, pa.int64()),
                    pa.array(np.full(len(lengths), task)), pa.array(turn),
                ],
                names=["id", "start", "length", "ids", "doc_tokens", "task", "turn"],
            )

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, start long, length long, ids binary, doc_tokens long, task long, turn long"
    return map_batches(rows, run, schema, keeps="packing").withColumnRenamed("id", id)


def pack_histogram(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, tuple[int, ...]]]:
    """Counted patterns of lengths: every length goes to the packs that are shortest so far."""
    packs: list[tuple[int, int, tuple[int, ...], int]] = []  # filled, tie-break, pattern, count
    made = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if packs and packs[0][0] + length <= sequence:
                filled, _, pattern, count = heapq.heappop(packs)
                copies, used = 1, min(count, left)
                if count > used:
                    made += 1
                    heapq.heappush(packs, (filled, made, pattern, count - used))
            else:
                copies = min(sequence // length, left)
                filled, pattern, used = 0, (), left // copies
            left -= copies * used
            made += 1
            heapq.heappush(packs, (filled + copies * length, made, pattern + (length,) * copies, used))
    return [(count, pattern) for _, _, pattern, count in sorted(packs)]


def pattern_slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Places for pieces: length, first and last rank that go there, first sequence, offset in it, sequences.

    A length that a pattern holds several times has one row: its ranks fill the first place of all
    sequences of the pattern, then the next place behind it.
    """
    ranks: dict[int, int] = {}
    slots, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length, copies in itertools.groupby(pattern):
            many = len(list(copies))
            first = ranks.get(length, 0)
            slots.append((length, first, first + count * many - 1, sequence, offset, count))
            ranks[length] = first + count * many
            offset += length * many
        sequence += count
    return slots


def pack_pieces(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` with their place: sequence_id and offset, without gaps from 0 within a sequence.

    Pieces are ranked per length by the task that made them and their turn there, so that a length
    which a third of all pieces share needs no task of its own. The driver sees one count per
    length; the broadcast slots are bounded by the lengths too.
    """
    spark = pieces.sparkSession
    counts = staged(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("many")), "piece-counts")
    histogram = {row["length"]: row["many"] for row in counts.groupBy("length").agg(F.sum("many").alias("many")).collect()}
    slots = spark.createDataFrame(
        pattern_slots(pack_histogram(histogram, sequence)) or [],
        "_length long, _first long, _last long, _sequence long, _offset long, _many long",
    )
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("_base"))
    ranked = pieces.join(small(bases, "bases"), ["length", "task"]).withColumn("_rank", F.col("_base") + F.col("turn"))
    here = (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("_first"), F.col("_last"))
    placed = ranked.join(F.broadcast(slots), here)
    place = F.col("_rank") - F.col("_first")
    copy = F.floor(place / F.col("_many"))
    return placed.withColumns(
        {"sequence_id": F.col("_sequence") + place % F.col("_many"), "offset": F.col("_offset") + copy * F.col("length")}
    ).drop("task", "turn", *[name for name in placed.columns if name.startswith("_")])


def pack(
    df: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, end: int = END
) -> DataFrame:
    """Pack the texts of ``df`` into sequences of at most ``sequence`` ids.

    Returns one row per piece: id, start, length, ids (32-bit, little-endian), doc_tokens,
    sequence_id, offset. A null text counts as empty and gives the id ``end`` alone; repeated rows
    and ids, null ids and other columns change nothing. Every id lies in exactly one piece. The
    pieces are written once, so ranks stay as they are when an executor is lost.
    """
    return pack_pieces(staged_texts(tokenized_pieces(df, vocabulary, id, text, sequence, end), "pieces"), sequence)
