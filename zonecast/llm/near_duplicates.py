"""Jaccard join of documents on word shingles, with prefix filters under several global orders.

Two sets this similar share a token among the first of each, whatever order all tokens stand in.
Candidates are found under the order of rising frequency and must also meet under two more orders;
what is left is verified on the whole sets. Documents with one set are one node from the start.

Frequencies come from an exchange: blocks of sets send their tokens to the owners of token ranges,
which answer with the frequency of those that several sets hold. A token of one set only stands
before all others in every order and needs no list.

Copies of a copy are joined through the least edited document of a token's list: first through one
hub each, then through the others that are still in another component. Only lists that hold several
components after that are compared within, the most frequent component with the others alone, and
only pairs that every order lets through are made, each under the first token that both share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from zonecast.llm.common import Remembered, give_back, held, list_array, map_batches, only, picked, slices, staged, staged_texts, unused
from zonecast.session import small

SHINGLE = 5
PERCENT = 80
BLOCK_TOKENS = 1 << 19
OWNER_CHARS = 1 << 23  # characters of text whose tokens one owner counts, on average
LEAST_OWNER_BITS = 6
STEPS = 8  # of frequency in each doubling
CACHED_WORDS = 100_000
CARRIED = 2048  # tokens of a set whose lists' rows carry arrays; longer sets' pairs are cut after the join
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
STEP = np.uint64(0x9E3779B97F4A7C15)
ORDERS = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


class _Words(Remembered):
    def make(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)


def _mixed(values: np.ndarray, factor: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(31))) * factor
        return values ^ (values >> np.uint64(29))


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    known = held("shingles", None, lambda: _Words(CACHED_WORDS))
    hashed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    many = len(words) - width + 1
    found = np.zeros(many, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            found = found * STEP + hashed[i : i + many]
    return np.unique(_mixed(found, STEP))


def _name(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers by the place of their bytes, as those of small ones compress then."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _needed(size, percent: int):
    """Least overlap of a set of ``size`` with any set this similar."""
    return -(-size * percent // 100)


def _watched(size, percent: int):
    """How many first tokens of a set, under any order, hold one of every set this similar."""
    return size - _needed(size, percent) + 1


SENT = "node long, n int, block long, owner int, low binary, counts binary, nodes binary, sizes binary, positions binary, starts binary"


def _block(block: int, nodes: list[int], sets: list[np.ndarray], owner_bits: int) -> list[dict]:
    """The rows of a block: its sets as places among its distinct tokens, and these for every owner.

    Tokens go by the bits that name their owner and 32 more. Counts of a block stop at 255.
    """
    tokens = np.concatenate(sets) >> np.uint64(32 - owner_bits)
    distinct, places, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    owners = (distinct >> np.uint64(32)).astype(np.int64)
    starts = np.searchsorted(owners, np.arange((1 << owner_bits) + 1))
    sizes = np.array([len(tokens) for tokens in sets])
    first = np.cumsum(sizes) - sizes
    steps = np.diff(places, prepend=0)
    steps[first] = places[first]
    rows = [{
        "block": block, "owner": -1, "nodes": np.array(nodes, np.int64).tobytes(), "sizes": _packed(sizes),
        "positions": _packed(steps), "starts": _packed(starts),
    }]
    counts = np.minimum(counts, 255).astype(np.uint8)
    for owner in np.flatnonzero(np.diff(starts)).tolist():
        low, high = starts[owner], starts[owner + 1]
        values = np.diff(distinct[low:high] & np.uint64(0xFFFFFFFF), prepend=np.uint64(0))
        rows.append({"block": block, "owner": owner, "low": _packed(values), "counts": counts[low:high].tobytes()})
    return rows


def _senders(width: int, owner_bits: int, schema: pa.Schema):
    """Per text: the name and size of its set. Per block of sets new to the task: the rows of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen, nodes, held = TaskContext.get().partitionId() << 16, set(), [], []
        for batch in slices(batches):
            sets = [shingle_set(text, width) for text in batch.column(1).to_pylist()]
            names = [_name(tokens) for tokens in sets]
            blank = [pa.nulls(len(sets), field.type) for field in list(schema)[3:]]
            own = [batch.column(0), pa.array(names, pa.int64()), pa.array(map(len, sets), pa.int32())]
            yield pa.RecordBatch.from_arrays([*own, *blank], schema=schema)
            for node, tokens in zip(names, sets, strict=True):
                if len(tokens) and node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    held.append(tokens)
            if sum(map(len, held)) >= BLOCK_TOKENS:
                yield pa.RecordBatch.from_pylist(_block(block, nodes, held, owner_bits), schema)
                block, nodes, held = block + 1, [], []
        if held:
            yield pa.RecordBatch.from_pylist(_block(block, nodes, held, owner_bits), schema)

    return run


def _frequencies(blobs: pd.DataFrame) -> pd.DataFrame:
    """One owner: for each block, those of its tokens that several sets hold, with their frequency's rank."""
    only(None)
    lists = [np.cumsum(_unpacked(blob), dtype=np.uint32) for blob in blobs["low"]]
    counts = np.frombuffer(b"".join(blobs["counts"]), np.uint8)
    _, at = np.unique(np.concatenate(lists), return_inverse=True)
    many = np.bincount(at, weights=counts)
    rank = np.where(many > 1, np.minimum(255, np.floor(STEPS * np.log2(many))), 0).astype(np.uint8)[at]
    answers, start = [], 0
    for block, owner, low in zip(blobs["block"], blobs["owner"], lists, strict=True):
        own = rank[start : start + len(low)]
        start += len(low)
        shared = np.flatnonzero(own)
        if len(shared):
            answers.append((block, owner, _packed(low[shared]), own[shared].tobytes(), _packed(shared)))
    return pd.DataFrame(answers, columns=["block", "owner", "low", "counts", "positions"])


PREFIX = (
    "token long, node long, n int, place int, row long, "
    "first_1 array<int>, first_2 array<int>, hidden_1 int, hidden_2 int"
)


def _filled(columns: dict, schema: pa.Schema) -> pa.Table:
    """A table of ``schema`` with the ``columns`` given and nulls in the others."""
    many = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(many, f.type) for f in schema]
    return pa.Table.from_arrays(arrays, schema=schema)


def _prefixes(percent: int):
    """One block: the first tokens of every set by rising frequency, and those under other orders.

    Tokens of one set only come first in all orders; only those after them are given. ``hidden``
    counts what has become one token by its bits.
    """
    schema = to_arrow_schema(T.StructType.fromDDL(PREFIX))

    def run(table: pa.Table) -> pa.Table:
        only(None)
        rows = table.to_pandas()
        own = rows["owner"] == -1
        head, answers = rows[own].iloc[0], rows[~own]
        block, starts, sizes = int(head["block"]), _unpacked(head["starts"]).astype(np.int64), _unpacked(head["sizes"]).astype(np.int64)
        nodes = np.frombuffer(head["nodes"], np.int64)
        rank, token = np.zeros(starts[-1], np.uint8), np.zeros(starts[-1], np.uint64)
        for owner, low, ranks, at in zip(answers["owner"], answers["low"], answers["counts"], answers["positions"], strict=True):
            at = starts[owner] + _unpacked(at).astype(np.int64)
            rank[at] = np.frombuffer(ranks, np.uint8)
            token[at] = np.uint64(owner << 32) | _unpacked(low).astype(np.uint64)
        steps = _unpacked(head["positions"]).astype(np.int64)
        ends = np.cumsum(sizes)
        first = ends - sizes
        positions = np.cumsum(steps)
        positions -= np.repeat(positions[first] - steps[first], sizes)
        alone = sizes - np.add.reduceat((rank[positions] > 0).astype(np.int64), first)
        room = _watched(sizes, percent) - alone
        found, lists = [], []
        for k in np.flatnonzero(room > 0).tolist():
            held, n, node, most = positions[first[k] : ends[k]], int(sizes[k]), int(nodes[k]), int(room[k])
            held = held[rank[held] > 0]
            if not len(held):
                continue
            tokens = token[held]
            order = np.lexsort((tokens, rank[held]))[:most]
            found.append((tokens[order], node, n, np.arange(alone[k], alone[k] + len(order))))
            watched = []
            for factor in ORDERS:
                ranked = np.sort(_mixed(tokens, factor))[:most]
                watched.append(np.unique(ranked.astype(np.uint32)).view(np.int32))
            hidden = [min(most, len(tokens)) - len(kept) for kept in watched]
            lists.append((node, n, (block << 20) + k, *watched, *hidden))
        give_back()
        if not found:
            return schema.empty_table()
        many = [len(tokens) for tokens, *_ in found]
        prefix = {
            "token": np.concatenate([tokens for tokens, *_ in found]).view(np.int64),
            "node": np.repeat([node for _, node, _, _ in found], many), "n": np.repeat([n for _, _, n, _ in found], many),
            "place": np.concatenate([places for *_, places in found]),
        }
        nodes = dict(zip(("node", "n", "row", "first_1", "first_2", "hidden_1", "hidden_2"), zip(*lists, strict=True), strict=True))
        return pa.concat_tables([_filled(prefix, schema), _filled(nodes, schema)])

    return run


def _whole_sets(width: int):
    """Per text: node and all tokens, with a number that is the row's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            sets = [shingle_set(text, width) for text in batch.column(0).to_pylist()]
            tokens = list_array(np.cumsum([0, *map(len, sets)]), pa.array(np.concatenate(sets).view(np.int64)))
            own = pa.array(np.arange(start, start + len(sets)))
            start += len(sets)
            yield pa.RecordBatch.from_arrays([pa.array(map(_name, sets), pa.int64()), own, tokens], names=["node", "row", "tokens"])

    return run


def _one_per_node(rows: DataFrame) -> DataFrame:
    """``rows`` without those whose node has a row of a lesser number: copies that other tasks met."""
    least = rows.groupBy("node").agg(F.min("row").alias("kept"), F.max("row").alias("last")).where("kept < last")
    again = rows.select("node", "row").join(least, "node").where("row <> kept").select("row")
    return rows.join(small(again, "repeated-rows"), "row", "left_anti")


def _sides(pairs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    for side in ("a", "b"):
        own = rows.select(F.col("node").alias(side), *[F.col(name).alias(f"{name}_{side}") for name in columns])
        pairs = pairs.join(own, side)
    return pairs


WATCHED = ("n", "first_1", "first_2", "hidden_1", "hidden_2")


def _pass(percent: int) -> Column:
    """Whether lengths and every further order let a pair through, whose columns end in _a and _b.

    Of the common tokens of two sets at most as many as either leaves out can lie beyond the watched
    ones; the rest, at least one, must be shared among these. What a shortened token may hide is
    allowed for.
    """
    n_a, n_b = F.col("n_a"), F.col("n_b")
    watch = lambda n: n - F.ceil(n * percent / 100) + 1
    common = F.ceil((n_a + n_b) * percent / (100 + percent) - 1e-9)
    beyond = F.greatest(n_a - watch(n_a), n_b - watch(n_b))
    passed = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    for k in (1, 2):
        shared = F.size(F.array_intersect(f"first_{k}_a", f"first_{k}_b")) + F.col(f"hidden_{k}_a") + F.col(f"hidden_{k}_b")
        passed = passed & (shared >= F.greatest(F.lit(1), common - beyond))
    return passed


def _met(pairs: DataFrame, watched: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that lengths and every further order let through, with ``together``."""
    both = _sides(pairs, watched, *WATCHED)
    return both.where(_pass(percent)).select("a", "b", (F.col("n_a") + F.col("n_b")).alias("together"))


def _verified(pairs: DataFrame, watched: DataFrame, texts_of, width: int, percent: int, label: str) -> DataFrame:
    """The pairs (a, b) that link: the filters of the further orders first, then whole sets."""
    met = staged(_met(pairs, watched, percent), f"{label}-met")
    nodes = met.select(F.col("a").alias("node")).unionByName(met.select(F.col("b").alias("node"))).distinct()
    sets = staged_texts(map_batches(texts_of(nodes), _whole_sets(width), "node long, row long, tokens array<long>", "shingles"), f"{label}-sets")
    both = _sides(met, _one_per_node(sets), "tokens")
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return both.where(100 * shared >= percent * (F.col("together") - shared)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b): the least node that links reach.

    Large-star and small-star rounds until nothing changes; the minimum per node combines in the map
    tasks and each round is written, so a node with any number of links is safe.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = staged(edges, "edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = staged(large.where("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        below = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = staged(below.unionByName(least.withColumnRenamed("least", "b")).distinct(), "edges")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not in one component of ``labels`` (node, label) yet."""
    for side in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}")), side, "left")
    return pairs.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")


def _may_overlap(place_a: Column, place_b: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether sets that share a token at these places can still share enough tokens."""
    most = F.least(place_a, place_b) + 1 + F.least(n_a - place_a, n_b - place_b) - 1
    return most * (100 + percent) >= percent * (n_a + n_b)


def _open_rows(labelled: DataFrame, watched: DataFrame) -> DataFrame:
    """The rows of lists that hold several components, with what cuts their pairs within a join.

    ``main`` is the list's most frequent component, ``before`` the node's tokens in open lists that
    come before this one. Sets of more than ``CARRIED`` tokens have null in place of arrays.
    """
    mixed = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    opened = staged(labelled.join(mixed.select("token"), "token", "left_semi").distinct(), "open-lists")
    main = opened.groupBy("token", "label").agg(F.count(F.lit(1)).alias("many"))
    main = main.groupBy("token").agg(F.max_by("label", F.struct("many", "label")).alias("main"))
    few = F.col("n") <= CARRIED
    carried = watched.select("node", "n", *[F.when(few, F.col(name)).alias(name) for name in WATCHED[1:]])
    held = opened.join(watched.where(few).select("node"), "node", "left_semi").groupBy("node").agg(
        F.collect_list(F.struct("place", "token")).alias("held")
    )
    before = F.transform(F.filter("held", lambda x: x["place"] < F.col("place")), lambda x: x["token"])
    rows = opened.join(carried, "node").join(held, "node", "left").join(main, "token")
    return staged(rows.select("token", "node", "place", "label", "main", *WATCHED, before.alias("before")), "open-rows")


def _across(labelled: DataFrame, watched: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a prefix token and pass every order.

    In a list, rows of its most frequent component meet the others only. A pair is made where it
    meets first, so what either set holds from there on bounds what they share. Pairs with a set too
    long to carry its arrays are made under every token and left to the filters that follow.
    """
    rows = _open_rows(labelled, watched)
    columns = ("node", "place", "label", "before", *WATCHED)
    a, b = (rows.select("token", "main", *[F.col(name).alias(f"{name}_{side}") for name in columns]) for side in "ab")
    a = a.where(F.col("label_a") != F.col("main")).drop("main")
    n_a, n_b = F.col("n_a"), F.col("n_b")
    once = (F.col("label_b") == F.col("main")) | (F.col("node_a") < F.col("node_b"))
    can = (F.col("label_a") != F.col("label_b")) & once & _may_overlap(F.col("place_a"), F.col("place_b"), n_a, n_b, percent)
    rest = F.least(n_a - F.col("place_a"), n_b - F.col("place_b"))
    meets_first = (rest * (100 + percent) >= percent * (n_a + n_b)) & ~F.arrays_overlap("before_a", "before_b")
    carried = F.col("before_a").isNotNull() & F.col("before_b").isNotNull()
    can = can & (~carried | (meets_first & _pass(percent)))
    across = a.join(b.withColumnRenamed("token", "token_b"), (F.col("token") == F.col("token_b")) & can)
    return across.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _members(
    df: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``df``: id, node, n, and id and node of the component's first row.

    The first has the least id, of these the least node; null ids come last.
    """
    rows = picked(df, id=id, text=text)
    chars = rows.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    owner_bits = max(LEAST_OWNER_BITS, int(np.ceil(np.log2(max(1, chars / OWNER_CHARS)))))
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL(SENT)])
    sent = staged_texts(map_batches(rows, _senders(width, owner_bits, to_arrow_schema(schema)), schema, "shingles"), "sets")
    nodes = sent.where("block is null").select("id", "node", "n")
    parts = sent.where("block is not null")
    of_block = "block long, owner int, low binary, counts binary, positions binary"
    answers = parts.where("owner >= 0").select("block", "owner", "low", "counts").groupBy("owner").applyInPandas(_frequencies, of_block)
    blocks = parts.where("owner = -1").select("block", "owner", "positions", "nodes", "sizes", "starts")
    blocks = blocks.unionByName(answers, allowMissingColumns=True)
    first = staged(blocks.groupBy("block").applyInArrow(_prefixes(percent), PREFIX), "prefixes")
    watched = staged(_one_per_node(first.where("token is null").select("row", "node", *WATCHED)), "watched")

    lists = first.where("token is not null").select("token", "node", "n", "place")
    hubs = lists.groupBy("token").agg(
        F.min(F.struct("place", "node")).alias("hub"), F.min("node").alias("low"), F.max("node").alias("high")
    )
    hubs = hubs.where("low < high").select("token", F.col("hub.node").alias("hub"), F.col("hub.place").alias("hub_place"))
    lists = staged(lists.join(hubs, "token"), "lists")
    near_hub = F.col("place") - F.col("hub_place") <= F.col("n") - F.ceil(F.col("n") * percent / 100)
    near = lists.where((F.col("node") != F.col("hub")) & near_hub)
    pair = [F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")]
    # A node's first hub alone: copies of one text meet there, and their other hubs need no look.
    one_hub = near.groupBy("node").agg(F.min(F.struct("hub_place", "hub")).alias("first")).select("node", "first.hub")
    one_hub = staged(one_hub.select(*pair).distinct(), "first-hubs")
    least = staged(nodes.where("n > 0").groupBy("node").agg(F.min("id").alias("id")), "nodes")

    def texts_of(wanted: DataFrame) -> DataFrame:
        ids = small(wanted.join(least, "node").select(F.col("id").alias("_id")).distinct(), "member-ids")
        return rows.join(ids, F.col("id").eqNullSafe(F.col("_id")), "left_semi").select("text")

    links = staged(_verified(one_hub, watched, texts_of, width, percent, "hub"), "hub-links")
    labels = staged(components(links), "labels")
    others = _apart(near.select(*pair).distinct(), labels).join(one_hub, ["a", "b"], "left_anti")
    others = staged(others, "other-hubs")
    links = links.unionByName(staged(_verified(others, watched, texts_of, width, percent, "other"), "other-links"))
    labels = staged(components(links), "labels")
    labelled = lists.select("token", "node", "place").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    labelled = staged(labelled, "labelled-lists")
    across = _across(labelled, watched, percent)
    across = staged(across.join(one_hub.unionByName(others), ["a", "b"], "left_anti"), "open-pairs")
    links = links.unionByName(_verified(across, watched, texts_of, width, percent, "open"))

    labels = components(links)
    named = least.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = staged(named, "named")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("first")
    smallest = named.groupBy("label").agg(first).select(
        "label", F.col("first.id").alias("component_id"), F.col("first.node").alias("component_node")
    )
    return nodes.join(named.select("node", "label").join(smallest, "label").drop("label"), "node", "left")


def jaccard_components(df: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``df``: id, n_shingles, component_id (the least id that links reach).

    A set holds the distinct shingles of ``width`` words, or the whole sequence where it is shorter;
    a text without words (null included) has none and is linked with nothing. Two rows link when
    their sets' intersection is at least ``percent`` % of their union, so rows repeated with text or
    id are one component. Null ids are never the least. An empty table gives no rows.

    Sets go by 64 bits of a hash, as their shingles do. Frequencies count tokens by fewer bits, 32 in
    each owner's range; two tokens taken for one share a list and its frequency, and no pair is lost.
    """
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    found = _members(df, id, text, **options)
    return found.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"))


def _node_of(text: Column, width: int) -> Column:
    @F.arrow_udf("long")
    def named(texts: pa.Array) -> pa.Array:
        return pa.array([_name(shingle_set(text, width)) for text in texts.to_pylist()], pa.int64())

    return named(text)


def one_per_component(
    df: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row of every component, with all columns of ``df``, and every row without words.

    The row with the least id stays, of these the least by set and then by all other columns; null
    ids come last. Rows whose id is not unique are told apart by their sets.
    """
    first = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("node") == F.col("component_node"))
    found = _members(df, id, text, width, percent).where("n > 0").select("id", "node", first.alias("first"))
    found = staged(found, "components")
    by_id = found.groupBy("id").agg(F.count_if("first").alias("firsts"), F.count(F.lit(1)).alias("many"))
    by_id = by_id.where("firsts = 0 or many > 1").select(F.col("id").alias("_id"), (F.col("firsts") > 0).alias("_some"))
    by_id = staged(by_id, "ids")
    unclear = by_id.where("_some").select("_id")
    firsts = found.where("first").join(small(unclear, "unclear"), F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    firsts = small(firsts.select(F.col("id").alias("_id"), F.col("node").alias("_node")).distinct(), "firsts")
    # The white space of shingle_set: rows without words are no part of what is told apart.
    words = df[f"`{text}`"].rlike(r"[^ \t\n\r\x0B\f]")
    same = lambda rows, side: rows[f"`{id}`"].eqNullSafe(side["_id"])
    gone, unclear = small(by_id, "gone"), small(unclear, "unclear")
    rest = df.join(gone, same(df, gone) & words, "left_anti")
    node = unused(df, "_node")
    seen = df.where(words).join(unclear, same(df, unclear), "left_semi")
    seen = seen.withColumn(node, _node_of(F.col(f"`{text}`"), width))
    columns = F.struct(*[F.col(f"`{name}`") for name in df.columns])
    one_each = (
        seen.join(firsts, same(seen, firsts) & (seen[node] == firsts["_node"]), "left_semi")
        .groupBy(F.col(f"`{id}`").alias("_id"), node).agg(F.min(columns).alias("_row")).select("_row.*")
    )
    return rest.unionByName(one_each)
