"""Secrets in text: fixed patterns, and strings whose sliding-window entropy is that of a key.

The entropy of a window follows from its counts of characters, which change by one character in and
one out at every step; the threshold depends on the character class that a string keeps to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import picked
from zonecast.llm.spans import in_order, let, located, where_any

KINDS = ("assign", "access", "hex", "entropy")
BASE_KINDS = KINDS[:3]
WINDOW = 20
TYPE = "array<struct<start:int,end:int,kind:string,value:string>>"

# What a base span of each kind is, written without retries inside a run.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
STRING = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
# Character classes: alphabet and least entropy in bits of some window, about 85 % of a random string's.
CLASSES = {
    "hex": ("0123456789abcdef", 2.8),
    "lower": ("0123456789abcdefghijklmnopqrstuvwxyz", 3.4),
    "mixed": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.5),
}
# Strings that look random and are no secrets: numbers, UUIDs, dates, paths of words, samples.
ALLOWED = (
    r"^[0-9+/_=-]+$",
    r"^[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{4,}.*$",
    r"^(?:[A-Za-z]{3,}+[0-9]{0,4}+[/_=-]++)++[A-Za-z]*+[0-9]{0,4}+$", r"(?i)(?:example|sample|dummy|placeholder|changeme|xxxx|0123456789|abcdefgh)",
)
# What words of letters lack: runs of consonants, and more than two parts of one or two letters between capitals.
LETTERS = r"^[A-Za-z+/_=-]+$"
CONSONANTS = r"(?i:[bcdfghjklmnpqrstvwxz]{6})"
SHORT_PART = r"[a-z][A-Z][a-z]?(?=[A-Z])"


def window_entropy(value: Column, alphabet: str, window: int = WINDOW) -> Column:
    """Greatest Shannon entropy, in bits, of ``window`` neighbouring characters of ``alphabet``.

    One pass: each step adds a character's change of c*log2(c) and takes the leaving one's away.
    """
    term = lambda c: F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(0.0)
    places = F.transform(F.split(value, ""), lambda c: F.position(c, F.lit(alphabet)))
    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")
    )

    def moved(state: Column, place: Column, by: int) -> Column:
        now = state["counts"][place]
        counts = F.transform(state["counts"], lambda c, i: F.when(i == place, c + by).otherwise(c))
        return F.struct(counts.alias("counts"), (state["sum"] + term(now + by) - term(now)).alias("sum"), state["best"].alias("best"))

    def step(state: Column, i: Column, at: Column) -> Column:
        added = lambda s: moved(s, at[i], 1)
        left = lambda s: F.when(i >= window, moved(s, at[F.greatest(i - window, F.lit(0))], -1)).otherwise(s)
        entropy = lambda s: F.when(i >= window - 1, F.log2(F.lit(float(window))) - s["sum"] / window).otherwise(0.0)
        return let(
            let(added(state), left),
            lambda s: F.struct(s["counts"], s["sum"], F.greatest(s["best"], entropy(s)).alias("best")),
        )

    return let(
        places,
        lambda at: F.aggregate(F.sequence(F.lit(0), F.size(at) - 1), start, lambda s, i: step(s, i, at), lambda s: s["best"]),
    )


def _random(value: Column) -> Column:
    allowed = reduce(lambda a, b: a | b, [value.rlike(pattern) for pattern in ALLOWED])
    words = value.rlike(LETTERS) & ~value.rlike(CONSONANTS) & (F.regexp_count(value, F.lit(SHORT_PART)) < 3)
    high = F.lit(False)
    for alphabet, least in reversed(CLASSES.values()):
        own = value if "A" in alphabet else F.lower(value)
        high = F.when(F.length(F.translate(own, alphabet, "")) == 0, window_entropy(own, alphabet) >= least).otherwise(high)
    return F.when(allowed | words, False).otherwise(high)


def _as(kind: str, matches: Column) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"], m["end"], F.lit(kind).alias("kind"), m["value"].alias("value")))


def with_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``base`` and ``spans``, arrays of structs (start, end, kind, value) in order.

    ``spans`` holds the base spans and, where they overlap none, strings of high entropy that no
    entry of the allow-list covers. A null text counts as empty and has no spans, an empty table gives
    no rows. Repeated rows, null ids and other columns change nothing. Positions are code points,
    ends exclusive. Patterns never go back inside a run, so strings of any length take linear time.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    sized = lambda matches, field, least: F.filter(matches, lambda m: F.length(m[field]) >= least)
    assign = _as("assign", sized(located(body, ASSIGN, 1), "group", 12))
    access = _as("access", sized(located(body, ACCESS), "value", 18))
    names = body.rlike("(?i)(?:password|passwd|secret|token|api_?key)")
    found = df.withColumns(
        {
            "_assign": where_any(names, assign, TYPE), "_access": where_any(body.contains("AKIA"), access, TYPE),
            "_hex": where_any(body.rlike("[0-9a-f]{16}"), _as("hex", located(body, HEX)), TYPE),
            "_string": where_any(body.rlike("[A-Za-z0-9+/_=-]{20}"), _as("entropy", located(body, STRING)), TYPE),
        }
    )
    found = found.withColumn("base", in_order(F.concat("_assign", "_access", "_hex"), KINDS))
    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    more = F.filter("_string", lambda s: apart(s) & _random(s["value"]))
    found = found.withColumn("spans", in_order(F.concat("base", more), KINDS))
    return found.drop("_assign", "_access", "_hex", "_string")


def secrets(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: id, base and spans of :func:`with_secrets`."""
    return with_secrets(picked(df, id=id, text=text)).select(F.col("id").alias(id), "base", "spans")
