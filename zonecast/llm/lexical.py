"""Ranked lexical search over document FP-trees.

Documents keep their counts of the items' terms only. Within a task, blocks of documents become a
tree: terms stand in order of falling document frequency, so documents share the nodes of the terms
that many of them hold. A node knows the greatest count of its term and the least length measure
among the documents below it; the sum of what the nodes of a path can give bounds the scores of all
documents below. Per item, a depth-first search takes the best branches first and leaves those whose
bound does not reach the item's results so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import list_array, list_values, map_batches, picked, slices, staged

TOP = 50
BLOCK_DOCUMENTS = 16_384
BLOCK_POSTINGS = 4_000_000
# Distinct (item, term) pairs searched in one pass over the documents; more take several passes.
PASS_TERMS = 200_000
LEAF_DOCUMENTS = 2_048
NO_ID = np.iinfo(np.int64).max
# Bytes of terms (digits, letters, all beyond ASCII), A-Z lower-cased; others part terms.
_IS_TERM = [48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)]
TERM_BYTES = bytes((c + 32 if 65 <= c <= 90 else c) if _IS_TERM[c] else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in their order, as UTF-8."""
    return text.encode().translate(TERM_BYTES).split() if text else []


def _factor(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _item_terms(df: DataFrame, id: str, text: str) -> DataFrame:
    """(item, id, term): the distinct terms of every row; ``item`` is the row's own number."""
    rows = picked(df, id=id, text=text)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(text))) for text in batch.column(1).to_pylist()]
            own = list_array(np.cumsum([0, *map(len, terms)]), pa.array([t for held in terms for t in held], pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), own], names=["id", "terms"])

    found = map_batches(rows, run, f"id {kind}, terms array<binary>").withColumn("item", F.monotonically_increasing_id())
    return found.select("item", "id", F.explode("terms").alias("term"))


def _vectors(rows: DataFrame, vocabulary) -> DataFrame:
    """Per document with a term: id, n (its terms with repeats), terms of the vocabulary and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in slices(batches):
            held = [terms_of(text) for text in batch.column(1).to_pylist()]
            n = np.array([len(words) for words in held], np.int64)
            width = np.int64(len(number) + 1)
            found = np.concatenate(
                [np.zeros(0, np.int64)]
                + [np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words)) for words in held]
            )
            row = np.repeat(np.arange(len(held)), n)
            keys, tf = np.unique((row * width + found)[found >= 0], return_counts=True)
            ends = np.searchsorted(keys, np.arange(len(held) + 1) * width)
            arrays = [
                batch.column(0), pa.array(n), list_array(ends, pa.array((keys % width).astype(np.int32))),
                list_array(ends, pa.array(tf.astype(np.int32))),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "terms", "tf"]).filter(pa.array(n > 0))

    return map_batches(rows, run, "id long, n long, terms array<int>, tf array<int>")


class DocumentTree:
    """FP-tree of one block: documents sorted by their terms, nodes in the order of a depth-first walk.

    ``ids``, ``m``: per document; ``start``, ``term``, ``tf``: per posting, terms as ranks by falling
    document frequency. A node covers the documents from ``low`` to below ``high``.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, start: np.ndarray, term: np.ndarray, tf: np.ndarray):
        lengths = np.diff(start)
        raw = [term[a:b].astype(">i4").tobytes() for a, b in zip(start[:-1], start[1:], strict=True)]
        order = np.array(sorted(range(len(raw)), key=raw.__getitem__), np.int64)
        at = np.repeat(start[:-1][order] - np.cumsum(lengths[order]) + lengths[order], lengths[order]) + np.arange(len(term))
        self.ids, self.m, self.term, self.tf = ids[order], m[order], term[at], tf[at]
        lengths = lengths[order]
        self.start = np.concatenate([[0], np.cumsum(lengths)])
        self.document = np.repeat(np.arange(len(order)), lengths)
        depth = np.arange(len(self.term)) - np.repeat(self.start[:-1], lengths)
        # How many first terms a document shares with the one before it.
        shared = np.zeros(len(order), np.int64)
        for k in range(1, len(order)):
            a, b = self.start[k - 1], self.start[k]
            most = min(lengths[k - 1], lengths[k])
            same = self.term[a : a + most] == self.term[b : b + most]
            shared[k] = most if same.all() else int(same.argmin())
        new = depth >= np.repeat(shared, lengths)
        first = np.flatnonzero(new)
        self.node_term, self.node_depth, self.low = self.term[first], depth[first], self.document[first]
        # The node of a posting: the last new one of its depth, at or before its document.
        by_depth = np.lexsort((self.document, depth))
        in_depth = np.lexsort((self.low, self.node_depth))
        node = np.empty(len(self.term), np.int64)
        node[by_depth] = in_depth[np.cumsum(new[by_depth]) - 1]
        self.greatest = np.zeros(len(first), np.int64)
        np.maximum.at(self.greatest, node, self.tf)
        self.least = np.full(len(first), NO_ID)
        np.minimum.at(self.least, node, self.m[self.document])
        self.high = np.zeros(len(first), np.int64)
        np.maximum.at(self.high, node, self.document + 1)
        self.bound = _factor(self.greatest, self.least)
        # Nodes and postings of each term.
        self.nodes_by_term = np.argsort(self.node_term, kind="stable")
        self.node_terms = self.node_term[self.nodes_by_term]
        self.postings_by_term = np.argsort(self.term, kind="stable")
        self.posting_terms = self.term[self.postings_by_term]

    def nodes_of(self, term: int) -> np.ndarray:
        a, b = np.searchsorted(self.node_terms, [term, term + 1])
        return self.nodes_by_term[a:b]

    def postings_of(self, term: int) -> np.ndarray:
        a, b = np.searchsorted(self.posting_terms, [term, term + 1])
        return self.postings_by_term[a:b]


class Best:
    """An item's results so far: the highest scores, of equal ones the least ids."""

    def __init__(self, top: int):
        self.top, self.scores, self.ids, self.seen = top, np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    @property
    def least(self) -> int:
        """What a score must reach to matter: equal ones may still win by their id."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        self.seen += len(scores)
        keep = scores >= self.least
        scores, ids = np.concatenate([self.scores, scores[keep]]), np.concatenate([self.ids, ids[keep]])
        order = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[order], ids[order]


def search_tree(tree: DocumentTree, weights: dict[int, int], best: Best) -> None:
    """Add what the tree holds of an item, a weight per term, to its results.

    The nodes of the item's terms form the tree of the item. Bottom-up, a node's reach is what its
    path from there on can give at most; the search goes down from the roots, highest reach first.
    """
    many = len(tree.ids)
    terms = sorted(term for term, weight in weights.items() if weight > 0)
    found = [(term, tree.nodes_of(term)) for term in terms]
    found = [(term, nodes) for term, nodes in found if len(nodes)]
    if not found:
        return
    # Deeper terms have higher ranks. Reach of a node stands at its first document until a node above takes it up.
    reach, best_below = [None] * len(found), np.zeros(many + 1, np.int64)
    for k in range(len(found) - 1, -1, -1):
        term, nodes = found[k]
        low, high = tree.low[nodes], tree.high[nodes]
        ends = np.empty(2 * len(nodes), np.int64)
        ends[::2], ends[1::2] = low, high
        below = np.maximum.reduceat(best_below, ends)[::2]
        reach[k] = weights[term] * tree.bound[nodes] + below
        best_below[low] = reach[k]
    # Top-down: the parent of a node is the last node of a lesser rank that covers it.
    owner, given, offset = np.full(many, -1), np.zeros(many, np.int64), 0
    parents, lows, highs, gains = [], [], [], []
    for term, nodes in found:
        low, high = tree.low[nodes], tree.high[nodes]
        parents.append(owner[low])
        gains.append(weights[term] * tree.bound[nodes])
        covered = np.repeat(np.arange(offset, offset + len(nodes)), high - low)
        at = np.repeat(low - np.cumsum(high - low) + (high - low), high - low) + np.arange(len(covered))
        owner[at] = covered
        given[at] += gains[-1][covered - offset]  # what a document's path gives at most
        lows.append(low)
        highs.append(high)
        offset += len(nodes)
    parent, low, high, gain, reach = map(np.concatenate, (parents, lows, highs, gains, reach))
    by_parent = np.lexsort((reach, parent))
    child_from = np.searchsorted(parent[by_parent], np.arange(-1, offset + 1))
    own_by = np.argsort(owner, kind="stable")
    own_from = np.searchsorted(owner[own_by], np.arange(-1, offset + 1))
    scored = [(weights[term], tree.postings_of(term)) for term, _ in found]
    scored = [(weight, postings, tree.document[postings]) for weight, postings in scored]

    def evaluate(documents: np.ndarray) -> None:
        documents = documents[given[documents] >= best.least]
        if not len(documents):
            return
        scores = np.zeros(len(documents), np.int64)
        first, last = documents[0], documents[-1] + 1
        for weight, postings, held in scored:
            a, b = np.searchsorted(held, [first, last])
            if a < b:
                part = held[a:b]
                at = np.searchsorted(documents, part)
                inside = documents[np.minimum(at, len(documents) - 1)] == part
                scores[at[inside]] += weight * _factor(tree.tf[postings[a:b][inside]], tree.m[part[inside]])
        positive = scores > 0
        best.take(scores[positive], tree.ids[documents[positive]])

    # (node, what the path above gives at most); children are pushed by rising reach, so the best comes next.
    stack = [(int(child), 0) for child in by_parent[child_from[0] : child_from[1]]]
    while stack:
        node, above = stack.pop()
        if above + reach[node] < best.least:
            continue
        if high[node] - low[node] <= LEAF_DOCUMENTS:
            evaluate(np.arange(low[node], high[node]))
            continue
        path = above + int(gain[node])
        own = own_by[own_from[node + 1] : own_from[node + 2]]
        if len(own) and path >= best.least:
            evaluate(np.sort(own))
        stack += [(int(child), path) for child in by_parent[child_from[node + 1] : child_from[node + 2]]]


def _searched(vectors: DataFrame, shared, top: int, documents: int, terms: int) -> DataFrame:
    """(item, id, score): the results of every task, which are at most ``top`` an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, items = shared.value  # rank of each term; per item its weights by rank
        best = {item: Best(top) for item in items}
        held: list[tuple[np.ndarray, ...]] = []
        size = [0, 0]

        def flush() -> None:
            if not held:
                return
            ids, m, lengths, term, tf = map(np.concatenate, zip(*held, strict=True))
            held.clear()
            size[:] = 0, 0
            tree = DocumentTree(ids, m, np.concatenate([[0], np.cumsum(lengths)]), term, tf)
            for item, weights in items.items():
                search_tree(tree, weights, best[item])

        for batch in slices(batches):
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            term, ends = list_values(batch.column(2))
            tf, _ = list_values(batch.column(3))
            lengths = np.diff(ends)
            ranked = rank[term]
            order = np.lexsort((ranked, np.repeat(np.arange(len(lengths)), lengths)))
            m = 50 + (50 * n * documents) // terms
            held.append((ids, m, lengths, ranked[order], tf[order].astype(np.int64)))
            size[0] += len(ids)
            size[1] += len(term)
            if size[0] >= BLOCK_DOCUMENTS or size[1] >= BLOCK_POSTINGS:
                flush()
        flush()
        for item, found in best.items():
            ids = pa.array(found.ids, mask=found.ids == NO_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found.ids), item)), ids, pa.array(found.scores)], names=["item", "id", "score"]
            )

    return map_batches(vectors, run, "item long, id long, score long")


def _one_pass(rows: DataFrame, wanted: DataFrame, top: int) -> DataFrame:
    """(item, id, score) for the items of ``wanted`` (item, term), which are few enough for one pass."""
    context = rows.sparkSession.sparkContext
    pairs = [(row["item"], bytes(row["term"])) for row in wanted.collect()]
    number = {term: k for k, term in enumerate(sorted({term for _, term in pairs}))}
    vectors = staged(_vectors(rows, context.broadcast(number)), "term-vectors")
    documents, terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents:
        return vectors.select(F.lit(0).cast("long").alias("item"), "id", F.col("n").alias("score")).where("false")
    df = np.zeros(len(number), np.int64)
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        df[row["term"]] = row["df"]
    rank = np.empty(len(df), np.int32)
    rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    weight = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
    items: dict[int, dict[int, int]] = {}
    for item, term in pairs:
        items.setdefault(item, {})[int(rank[number[term]])] = int(weight[number[term]])
    return _searched(vectors.where(F.size("terms") > 0), context.broadcast((rank, items)), top, documents, terms)


def lexical_search(
    documents: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", top: int = TOP, pass_terms: int = PASS_TERMS,
) -> DataFrame:
    """(item_id, rank, id, score): the ``top`` highest-scoring documents of every row of ``items``.

    Terms are runs of digits, ASCII letters and characters beyond ASCII. Documents without a term
    (null and empty texts) take no part; items without one, or whose terms no document holds, have no
    rows. Scores above 0 only; equal scores by ascending id, a null id last. Rows that repeat an id
    are documents, or items, of their own. Other columns change nothing; empty tables give no rows.

    ``id`` is a whole number. What is sent to every task is bounded by ``pass_terms`` (an item's
    terms stay together): more items take several passes over the documents. Scoring is exact; the
    bounds only spare documents that cannot reach an item's results.
    """
    rows = picked(documents, id=id, text=text).withColumn("id", F.col("id").cast("long"))
    wanted = staged(_item_terms(items, item_id, item_text), "item-terms")
    passes = max(1, -(-wanted.count() // pass_terms))
    found = None
    for k in range(passes):
        mine = wanted if passes == 1 else wanted.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == k)
        part = _one_pass(rows, mine.select("item", "term"), top)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = wanted.groupBy("item").agg(F.first("id").alias("item_id"))
    return best.join(names, "item").select(F.col("item_id").alias(item_id), "rank", F.col("id").alias(id), "score")
