"""Exact dedup by an exchange of Golomb-coded fingerprints.

Every block of rows sends its sorted fingerprints, Golomb-coded, to the owners of the fingerprint
ranges. An owner answers each block with a bitmap of those that another block holds as well. Only
the suspects' texts are then shuffled and compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import map_batches, picked, staged, unused
from zonecast.session import small

FINGERPRINT_BITS = 63
BLOCK_ROWS = 1 << 18
OWNER_ROWS = 1 << 19
LEAST_OWNER_BITS = 6


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct non-negative integers as gaps coded with a power of two as parameter.

    Head: count and k. Then the quotients of the gaps in unary, then the remainders in k bits each.
    """
    gaps = np.diff(values, prepend=np.int64(0)).astype(np.uint64)
    k = int(np.log2(max(1.0, float(gaps.mean()))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    shifts = np.arange(k, dtype=np.uint64)
    remainders = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    head = np.array([len(gaps), k, len(unary)], np.uint32).tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(remainders).tobytes()


def golomb_decode(blob: bytes) -> np.ndarray:
    """The integers of :func:`golomb_encode`."""
    count, k, length = (int(x) for x in np.frombuffer(blob, np.uint32, 3))
    rest = np.frombuffer(blob, np.uint8, offset=12)
    cut = (length + 7) // 8
    stops = np.flatnonzero(np.unpackbits(rest[:cut], count=length) == 0)
    gaps = (np.diff(stops, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(rest[cut:], count=count * k).reshape(count, k).astype(np.uint64)
        gaps |= (bits << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps).astype(np.int64)


def _block(block: int, rows: pa.Table, owner_bits: int) -> Iterator[pa.RecordBatch]:
    prints = rows.column("fp").to_numpy()
    distinct, place, copies = np.unique(prints, return_inverse=True, return_counts=True)
    owners = distinct >> (FINGERPRINT_BITS - owner_bits)
    starts = np.flatnonzero(np.diff(owners, prepend=-1))
    ends = np.append(starts[1:], len(owners))
    first = np.zeros(len(owners), np.int64)
    for start, end in zip(starts, ends, strict=True):
        first[start:end] = start
    sent = [golomb_encode(distinct[a:b]) for a, b in zip(starts, ends, strict=True)]
    names = ("id", "sha", "block", "owner", "place", "twice", "blob")
    n, m = len(prints), len(sent)
    thin = [
        *rows.select(["id", "sha"]).columns, pa.array(np.full(n, block)), pa.array(owners[place].astype(np.int32)),
        pa.array((place - first[place]).astype(np.int32)), pa.array(copies[place] > 1), pa.nulls(n, pa.binary()),
    ]
    blobs = [
        pa.nulls(m, rows.schema.field("id").type), pa.nulls(m, rows.schema.field("sha").type), pa.array(np.full(m, block)),
        pa.array(owners[starts].astype(np.int32)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.bool_()), pa.array(sent, pa.binary()),
    ]
    for columns in (thin, blobs):
        yield from pa.table(columns, names=list(names)).to_batches()


def _senders(owner_bits: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= block_rows:
                yield from _block(block, pa.Table.from_batches(held), owner_bits)
                held, block = [], block + 1
        if sum(map(len, held)):
            yield from _block(block, pa.Table.from_batches(held), owner_bits)

    return run


def _answer(blobs: pd.DataFrame) -> pd.DataFrame:
    """One owner: which fingerprints of each block occur in another block too."""
    lists = [golomb_decode(blob) for blob in blobs["blob"]]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = values[counts > 1]
    maps = [np.packbits(np.isin(held, shared, assume_unique=True)).tobytes() for held in lists]
    return pd.DataFrame({"block": blobs["block"], "owner": blobs["owner"], "bitmap": maps})


def _bit(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(bitmap.substr(F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(128 >> i) for i in range(8)]), place % 8 + 1)) > 0


def _suspects(rows: DataFrame, count: int, block_rows: int) -> DataFrame:
    """Every row (id, sha) with a mark whether another row may have the same text."""
    owner_bits = max(LEAST_OWNER_BITS, int(np.ceil(np.log2(max(1, count / OWNER_ROWS)))))
    id_type = rows.schema["id"].dataType.simpleString()
    prints = rows.select(
        "id", F.unhex(F.sha2("text", 256)).alias("sha"),
        F.shiftrightunsigned(F.xxhash64("text"), 64 - FINGERPRINT_BITS).alias("fp"),
    )
    schema = f"id {id_type}, sha binary, block long, owner int, place int, twice boolean, blob binary"
    exchanged = staged(map_batches(prints, _senders(owner_bits, block_rows), schema), "fingerprints")
    blobs = exchanged.where("blob is not null").select("block", "owner", "blob")
    bitmaps = blobs.groupBy("owner").applyInPandas(_answer, "block long, owner int, bitmap binary")
    thin = exchanged.where("blob is null").drop("blob")
    marked = thin.join(bitmaps, ["block", "owner"], "left")
    return marked.select("id", "sha", (F.col("twice") | _bit(F.col("bitmap"), F.col("place"))).alias("suspect"))


def exact_groups(
    df: DataFrame, id: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per row of ``df``: id, keep_id, group_size, kept, text_sha256 and same_id.

    Equal texts form a group, of which the row with the largest id stays. A null text counts as
    empty. A null id is smaller than any other. Of rows repeated with id and text exactly one is
    kept; ``same_id`` counts them. Other columns are ignored; an empty table gives no rows.

    A hot group sends one fingerprint per block and, as texts are grouped with map-side combining,
    one text per task; its members join as thin rows, which adaptive execution splits.
    """
    rows = picked(df, id=id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    marked = staged(_suspects(rows, df.count(), block_rows), "suspects")
    members = marked.where("suspect").groupBy("id", "sha").agg(F.count(F.lit(1)).alias("same_id"))
    ids = small(members.select(F.col("id").alias("_id")).distinct(), "suspect-ids")
    texts = rows.join(ids, F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    equal = texts.groupBy("text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = equal.select(F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size")
    dropped_or_kept = members.join(groups, "sha").withColumn(
        "turn", F.explode(F.sequence(F.lit(1), F.col("same_id").cast("int")))
    )
    hex_sha = F.lower(F.hex("sha")).alias("text_sha256")
    kept = (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept")
    alone = marked.where("not suspect").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), hex_sha, F.lit(1).cast("long").alias("same_id"),
    )
    found = dropped_or_kept.select("id", "keep_id", "group_size", kept, hex_sha, "same_id")
    return found.unionByName(alone).withColumnRenamed("id", id)


def drop_exact_copies(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that :func:`exact_groups` keeps, with all their columns.

    Of rows that repeat both id and text, the least by all other columns stays.
    """
    groups = staged(exact_groups(df, id, text), "groups")
    own = F.col(f"`{id}`").alias("_id"), F.col("text_sha256").alias("_sha")
    repeated = groups.where("kept and same_id > 1").select(*own).distinct()
    gone = groups.where("not kept").select(*own).distinct()
    sha = unused(df, "_text_sha256")
    hashed = df.withColumn(sha, F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256))
    same = lambda side: hashed[id].eqNullSafe(side["_id"]) & (hashed[sha] == side["_sha"])
    gone, repeated = small(gone, "gone"), small(repeated, "repeated")
    rest = hashed.join(gone, same(gone), "left_anti")
    columns = F.struct(*[F.col(f"`{name}`") for name in df.columns])
    one_each = (
        hashed.join(repeated, same(repeated), "left_semi")
        .groupBy(F.col(f"`{id}`").alias("_id"), sha).agg(F.min(columns).alias("_row")).select("_row.*")
    )
    return rest.drop(sha).unionByName(one_each)
