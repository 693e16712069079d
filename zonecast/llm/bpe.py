"""Byte-level BPE: text to token ids by ranked merges, and back.

Text is cut at white space into chunks that no match of the pattern crosses. A task folds the merges
over each distinct chunk it meets once and joins the ids of a text's chunks; decoding joins the
bytes of the ids.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import Remembered, held, list_array, list_values, map_batches, picked, slices
from zonecast.llm.spans import let

# The code points with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
CACHED_CHUNKS = 400_000
HEAP_FROM = 256
RANK_MAPS = 8192


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def fold_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: always merge the pair of the least rank, the leftmost of several."""
    if word in ranks:
        return [ranks[word]]
    if len(word) >= HEAP_FROM:
        return _fold_long(word, ranks)
    none = len(ranks) + (1 << 40)
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while pairs and (least := min(pairs)) < none:
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i > 0:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[part] for part in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs, n log n for words of any length."""
    n = len(word)
    parts: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[word[i : i + 2]], i, word[i : i + 2]) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, merged = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else n
        if j >= n or parts[i] + parts[j] != merged:
            continue
        parts[i], parts[j] = merged, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (pair := parts[a] + parts[b]) in ranks:
                heapq.heappush(heap, (ranks[pair], a, pair))
    return [ranks[part] for part in parts if part is not None]


class _Chunks(Remembered):
    """Chunk of text to its ids as bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__(CACHED_CHUNKS)
        self.ranks = ranks
        white = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.words = regex.compile(white)

    def make(self, chunk: str) -> bytes:
        ids = [id for word in self.words.findall(chunk) for id in fold_merges(word.encode(), self.ranks)]
        return np.array(ids, np.int32).tobytes()


def _chunks(ranks: dict[bytes, int], pattern: str) -> _Chunks:
    """The worker's cache, kept from task to task for the same vocabulary."""
    return held("bpe", (hash(frozenset(ranks.items())), pattern), lambda: _Chunks(ranks, pattern))


def bpe_encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its id and ``ids``, the token ids of its text, each match of ``pattern`` by itself.

    A null text counts as empty and gives no ids. Rows are independent: repeated rows and ids, null
    ids and other columns change nothing, and texts of any length are encoded whole.
    """
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    rows = picked(df, id=id, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _chunks(shared.value, pattern)
        for batch in slices(batches):
            encoded = [b"".join(map(chunks.__getitem__, CHUNK.findall(t))) if t else b"" for t in batch.column(1).to_pylist()]
            offsets = np.cumsum([0, *map(len, encoded)]) // 4
            ids = list_array(offsets, pa.array(np.frombuffer(b"".join(encoded), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["id", "ids"])

    id_type = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, run, f"id {id_type}, ids array<int>", keeps="bpe").withColumnRenamed("id", id)


def bpe_decode(df: DataFrame, ranks: dict[bytes, int], id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: its id, ``ids`` and ``decoded``, the joined bytes of the ids (null ids: empty)."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    rows = picked(df, id=id, ids=ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = {rank: token for token, rank in shared.value.items()}
        for batch in slices(batches):
            flat, ends = list_values(batch.column(1))
            decoded = [b"".join(map(pieces.__getitem__, flat[a:b].tolist())) for a, b in pairwise(ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], names=["id", "ids", "decoded"])

    id_type = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, run, f"id {id_type}, ids array<int>, decoded binary").withColumnRenamed("id", id)


def fold_words(words: DataFrame, ranks: dict[bytes, int], word: str = "word") -> DataFrame:
    """``words`` with ``ids``: the fold of ranked merges over the bytes of each word, as an expression.

    The ranks are a literal: an array of small maps, found by the crc32 of a token's bytes, as a map
    is searched from its start. Each step of the fold merges the leftmost pair of the least rank.
    Meant for a table of distinct words; whole texts go through :func:`bpe_encode`.
    """
    maps: list[dict[str, int]] = [{} for _ in range(RANK_MAPS)]
    for token, rank in ranks.items():
        maps[zlib.crc32(token) % RANK_MAPS][token.hex().upper()] = rank
    literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")
    none = F.lit(len(ranks) + 1)

    def rank(token: Column) -> Column:
        return F.coalesce(F.try_element_at(literal[(F.crc32(token) % RANK_MAPS).cast("int")], F.hex(token)), none)

    def step(parts: Column, _: Column) -> Column:
        rest = F.greatest(F.size(parts) - 1, F.lit(0))
        joined = F.zip_with(F.slice(parts, 1, rest), F.slice(parts, 2, rest), lambda a, b: F.concat(a, b))
        return let(
            F.struct(joined.alias("pairs"), F.transform(joined, rank).alias("ranks")),
            lambda found: let(
                F.array_position(found["ranks"], F.array_min(found["ranks"])).cast("int"),
                lambda i: F.when((F.size(parts) < 2) | (F.array_min(found["ranks"]) == none), parts).otherwise(
                    F.concat(
                        F.slice(parts, 1, i - 1), F.array(F.element_at(found["pairs"], F.greatest(i, F.lit(1)))),
                        F.slice(parts, i + 2, F.size(parts)),
                    )
                ),
            ),
        )

    raw = F.encode(F.col(word), "UTF-8")
    single = F.transform(F.sequence(F.lit(1), F.octet_length(word)), lambda i: raw.substr(i, F.lit(1)))
    folded = F.transform(F.aggregate(F.sequence(F.lit(1), F.octet_length(word)), single, step), rank)
    return words.withColumn("ids", F.when(rank(raw) < none, F.array(rank(raw))).otherwise(folded))


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)
