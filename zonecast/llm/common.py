"""What the operators of this folder share: reading tables, staging, and batches of Arrow rows."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import stage


SLICE_ROWS = 500
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator works on, under its own names, so that others cannot clash."""
    return df.select(*[df[f"`{name}`"].alias(own) for own, name in columns.items()])


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    while name.lower() in (column.lower() for column in df.columns):
        name += "_"
    return name


def id_remainder(id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % parts


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, keeps: str | None = None
) -> DataFrame:
    """Apply ``run`` to the Arrow batches of every partition; nothing is held beyond one batch.

    Workers outlive stages: a task's end gives back what it does not use, which else stands beside the next stage's memory.
    ``keeps`` names the operator whose caches the workers may keep, see :func:`held`.
    """

    def started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(keeps)
        yield from run(batches)
        give_back()

    return df.mapInArrow(started, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into parts of at most ``rows`` rows, so that what is made of a part stays small.

    Workers outlive their tasks: what is unused is given back at the end of each batch.
    """
    for batch in batches:
        for low in range(0, len(batch), rows):
            yield batch.slice(low, rows)
        give_back()


def list_array(offsets, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def list_values(lists: pa.ListArray) -> tuple[np.ndarray, list[int]]:
    """All values of an array of lists, and where each list starts and ends; null lists are empty."""
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values, np.cumsum([0, *lists.value_lengths().fill_null(0).to_pylist()]).tolist()


@contextmanager
def sliced_batches(spark: SparkSession, rows: int = SLICE_ROWS) -> Iterator[None]:
    """Workers get batches of at most ``rows`` rows from what runs within: whole texts stand in both processes as one batch."""
    before = spark.conf.get(BATCH_KEY)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(BATCH_KEY, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_KEY, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder: lost executors cost no recomputation of it."""
    return stage(df, f"llm-{label}")


def staged_texts(df: DataFrame, label: str) -> DataFrame:
    """:func:`staged` for what workers make of whole texts a slice at a time."""
    with sliced_batches(df.sparkSession):
        return staged(df, label)


_HELD: dict[str, tuple[Hashable, Any]] = {}


def only(operator: str | None) -> None:
    """Let go of what this worker keeps for all other operators.

    Workers outlive stages and serve one operator after the other; what they keep for one would
    stand in memory beside that of the next.
    """
    others = [name for name in _HELD if name != operator]
    for name in others:
        del _HELD[name]
    if others:
        give_back()


def held(operator: str, key: Hashable, make: Callable[[], Any]) -> Any:
    """What this worker has made under ``key``, kept from task to task until another operator or key comes."""
    only(operator)
    if operator not in _HELD or _HELD[operator][0] != key:
        _HELD[operator] = key, make()
    return _HELD[operator][1]


def give_back() -> None:
    """Return to the system what Arrow and the C library hold unused."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


class Remembered(dict):
    """What a worker has made of keys; keeps between one and two times ``limit`` of the latest."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def make(self, key):
        raise NotImplementedError

    def put(self, key, value):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def take(self, found: dict) -> None:
        """Keep what has been made of many keys; the older generation goes where both would be too many."""
        if len(self) + len(found) > self.limit:
            self.old = dict(self)
            self.clear()
        self.update(found)

    def __missing__(self, key):
        found = self.old.get(key)
        return self.put(key, self.make(key) if found is None else found)

    def unknown(self, keys) -> list:
        """The distinct ``keys`` still to be made; those of the older generation are taken over."""
        new = [key for key in set(keys) if key not in self]
        for key in new:
            if key in self.old:
                self.put(key, self.old[key])
        return [key for key in new if key not in self]
