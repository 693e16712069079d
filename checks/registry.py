"""Registration of queries with their SQL, and shared table expressions for that SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.expressions import EXPRESSIONS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _needed(text: str, seen: dict[str, None]) -> dict[str, None]:
    for name in re.findall(r"\b[a-z_]+\b", text):
        if name in EXPRESSIONS and name not in seen:
            _needed(EXPRESSIONS[name], seen)
            seen[name] = None
    return seen


def with_expressions(body: str) -> str:
    """Put the table expressions that ``body`` uses in front of it, in order of use."""
    names = _needed(body, {})
    if not names:
        return body
    parts = ",\n".join(f"{name} AS MATERIALIZED ({EXPRESSIONS[name]})" for name in names)
    return f"WITH {parts}\n{body}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_expressions(sql)
        return function

    return register
