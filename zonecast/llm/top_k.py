"""Exact top-k inner products with bounds from segment means and deviations, coarse to fine.

The squared distance of two vectors is at least what their segments' means and deviations differ by,
so their inner product is at most the sum over segments of length x (mean x mean + deviation x
deviation). Candidates whose bound falls below a query's k-th score so far are dropped level by
level; exact products are computed for the survivors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import list_values, map_batches, staged

LEVELS = (1, 4, 16)
SCALE = 256
CANDIDATES = 2048  # vectors in a block
QUERIES = 512
BLOCKS = 16  # blocks of candidates that meet a block of queries in one group


def _packed(most: int):
    """Vectors to blocks of at most ``most`` of one length: size, ids and values as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            values, ends = list_values(batch.column(1))
            sizes = np.diff(ends)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                for low in range(0, len(own), most):
                    rows = own[low : low + most]
                    matrix = values[(np.asarray(ends)[rows][:, None] + np.arange(size))].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([size], pa.int32()), pa.array([ids[rows].astype(np.int64).tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary())],
                        names=["size", "ids", "matrix"],
                    )

    return run


def _unpacked(block) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(block.ids, np.int64)
    return ids, np.frombuffer(block.matrix, np.int64).reshape(len(ids), block.size)


def segment_statistics(matrix: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each row's segments, scaled so that their product is the bound."""
    found = []
    for part in np.array_split(matrix.astype(float), min(segments, matrix.shape[1]), axis=1):
        root = math.sqrt(part.shape[1])
        found += [part.mean(axis=1) * root, part.std(axis=1) * root]
    return np.stack(found, axis=1)


def block_top(queries: np.ndarray, query_ids: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[int, int]]]:
    """Per query the ``k`` best (score, id) of the blocks' other vectors, ties to smaller ids."""
    best: list[list[tuple[int, int]]] = [[] for _ in query_ids]
    if queries.shape[1] == 0:
        for ids, _ in blocks:
            for i, own in enumerate(query_ids.tolist()):
                best[i] = sorted(best[i] + [(0, j) for j in ids.tolist() if j != own], key=lambda x: (-x[0], x[1]))[:k]
        return best
    coarse = [segment_statistics(queries, segments) for segments in LEVELS]
    for ids, matrix in blocks:
        levels = [segment_statistics(matrix, segments) for segments in LEVELS]
        finest = coarse[-1] @ levels[-1].T
        for i, own in enumerate(query_ids.tolist()):
            others = ids != own
            if len(best[i]) < k:
                first = np.argsort(np.where(others, -finest[i], np.inf), kind="stable")[: min(k, int(others.sum()))]
                seen = (matrix[first] @ queries[i]).tolist() + [score for score, _ in best[i]]
                least = sorted(seen, reverse=True)[k - 1] if len(seen) >= k else None
            else:
                least = best[i][-1][0]
            alive = np.flatnonzero(others)
            if least is not None:
                for own_level, level in zip(coarse, levels, strict=True):
                    bound = level[alive] @ own_level[i]
                    alive = alive[bound + 0.5 + 1e-9 * np.abs(bound) >= least]
            scores = matrix[alive] @ queries[i]
            order = np.lexsort((ids[alive], -scores))[:k]
            found = list(zip(scores[order].tolist(), ids[alive][order].tolist(), strict=True))
            best[i] = sorted(best[i] + found, key=lambda x: (-x[0], x[1]))[:k]
    return best


def top_k(df: DataFrame, k: int = 5, every: int = 50, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` best partners of every vector whose id is divisible by ``every``.

    Returns query_id, rank (from 1), vec_id and score, the inner product of floor(256 x). Vectors
    that are null or hold null or non-finite components take no part, nor do null ids. Every other
    row is a candidate, repeated ones too; rows with the query's id are its own. Of several vectors
    with one id the least is the query. Vectors meet those of their own length. Sums are exact while
    they fit 63 bits. Other columns are ignored.

    Blocks of queries meet blocks of candidates in groups of bounded size, and each group returns k
    rows a query.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(SCALE * x.cast("double")).cast("long"))
    kept = df.where(F.col(vector).isNotNull() & F.col(id).isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = kept.select(F.col(id).cast("long").alias("id"), whole.alias("v"))
    asked = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    schema = "size int, ids binary, matrix binary"
    asked = staged(asked, "queries")
    parts = max(1, math.ceil(asked.count() / QUERIES))
    asked = staged(map_batches(asked.repartition(parts), _packed(QUERIES), schema), "query-blocks")
    given = staged(map_batches(rows, _packed(CANDIDATES), schema), "candidate-blocks")
    spread = max(1, math.ceil(given.count() / BLOCKS))
    many = asked.count()
    # Groups are drawn from the blocks' content, so that a repeated task draws the same.
    drawn = lambda most: F.pmod(F.xxhash64("ids"), F.lit(max(1, most))).cast("int")
    left = asked.withColumn("q", drawn(many)).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    right = given.withColumn("g", drawn(spread)).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(max(0, many - 1)))))

    def meet(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = []
        blocks = [_unpacked(block) for block in candidates.itertuples()]
        for block in queries.itertuples():
            ids, matrix = _unpacked(block)
            for own, best in zip(ids.tolist(), block_top(matrix, ids, blocks, k), strict=True):
                found += [(own, other, score) for score, other in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ["size", "q", "g"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
