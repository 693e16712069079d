"""Spans of text found by regular expressions, as DataFrame expressions.

Positions count code points from 0, ends are exclusive. Patterns are written so that a match never
backs out of a long run: possessive repeats, and starts that do not retry inside the run before them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64


def sums_before(values: Column) -> Column:
    """For each element of an array of ints the sum of those before it, by blocks."""
    add = lambda array: F.aggregate(array, F.lit(0), lambda a, b: a + b)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(values) / BLOCK).cast("int")), lambda b: add(F.slice(values, b * BLOCK + 1, BLOCK))
    )
    bases = let(blocks, lambda found: F.transform(found, lambda _, b: add(F.slice(found, 1, b))))
    block = lambda i: F.floor(i / BLOCK).cast("int")
    rest = lambda i: add(F.slice(values, i - i % BLOCK + 1, i % BLOCK))
    return let(bases, lambda base: F.transform(values, lambda _, i: base[block(i)] + rest(i)))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of structs (start, end, value, group) of all matches of a pattern, left to right."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    return let(F.struct(whole.alias("v"), groups.alias("g"), F.split(text, pattern, -1).alias("b")), _with_starts)


def _with_starts(found: Column) -> Column:
    lengths = F.transform(found["v"], lambda v, i: F.length(v) + F.length(found["b"][i]))
    start = lambda before, i: before[i] + F.length(found["b"][i])
    return let(
        let(lengths, sums_before),
        lambda before: F.transform(
            found["v"],
            lambda v, i: F.struct(
                start(before, i).alias("start"), (start(before, i) + F.length(v)).alias("end"),
                v.alias("value"), found["g"][i].alias("group"),
            ),
        ),
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of structs, in its order, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def in_order(spans: Column, kinds: Sequence[str]) -> Column:
    """Sorted by start, then by the place of the kind among ``kinds``."""
    order = F.array(*[F.lit(kind) for kind in kinds])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("k"), F.array_position(order, s["kind"]).alias("o"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda x: x["s"])


def where_any(condition: Column, array: Column, kind: str) -> Column:
    """The array where the condition holds, else an empty one of type ``kind``."""
    return F.when(condition, array).otherwise(F.array().cast(kind))
