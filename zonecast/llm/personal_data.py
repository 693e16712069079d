"""Personal data by weak supervision: labelers vote, their reliabilities and a classifier are learned.

Strict patterns give base spans, which always stay; looser patterns give further candidates. On every
candidate a pattern, a gazetteer, a context, a border and a filler labeler vote. The votes of all
candidates, counted, go through expectation-maximisation; the resulting beliefs train a classifier
over a span's features, which decides which of the further candidates become spans.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import picked, staged
from zonecast.llm.spans import in_order, located, span_text, where_any

KINDS = ("email", "ip", "card", "phone", "ssn")
BASE_KINDS = KINDS[:4]
ROUNDS = 25
ADD_FROM = 0.9
LEFT_CHARS = 32
FILLER_CHARS = 64

# What a base span of each kind is, written without retries inside a run.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further candidates: addresses spelled out, numbers in national form, social security numbers.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}+\x20?(?:[\[(](?:dot|DOT)[\])]|\.)\x20?[A-Za-z]{2,12}+",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])",
    "ssn": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z.-])",
}
OCTET = r"0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
FOUND = "array<struct<start:int,end:int,kind:string,strict:boolean,value:string>>"
# Gazetteer: endings of mail hosts, first digits of card issuers, countries' calling codes.
GAZETTEER = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|int|info|biz|io|de|fr|es|uk|us|eu|ch|at|it|nl|be|pt|ca|au|br|mx|jp|cn|in)$",
    "ip": r"^(?!0|127\.|255\.)",
    "card": r"^(?:3[4-7]|4|5[1-5]|2[2-7]|6(?:011|5|4))",
    "phone": r"^(?:\+(?:1|7|2[07]|3[0-4679]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9])",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
}
# Words that announce each kind, in the languages of the gazetteer.
CONTEXT = {
    "email": r"(?i)(?:e-?mail|correo|courriel|mailto|contact|write to)",
    "ip": r"(?i)(?:\bip\b|address|host|server|adresse|dirección)",
    "card": r"(?i)(?:card|visa|master|amex|karte|carte|tarjeta|credit|pay)",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|rufen|appel|llam)",
    "ssn": r"(?i)(?:ssn|social|security)",
}
FILLER = r"^(?:[^0-9]*([0-9])(?:[^0-9]*\1)*[^0-9]*|[^0-9]*1[^0-9]*2[^0-9]*3[^0-9]*4[^0-9]*5.*)$"
VOTES = ("pattern", "gazetteer", "context", "border", "filler")
FEATURES = ("strict", "size", "left", "right", "announced", "listed")


def _luhn(value: Column) -> Column:
    digits = F.transform(F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), ""), lambda c: c.cast("int"))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d < 5, 2 * d).otherwise(2 * d - 9))
    total = F.aggregate(doubled, F.lit(0), lambda a, b: a + b)
    return F.when(F.length(value) <= 40, total % 10 == 0).otherwise(False)


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        return _digits(value).between(14, 19) & _luhn(value)
    if kind == "phone":
        return _digits(value).between(10, 15)
    return F.lit(True)


def _found(text: Column, kind: str, pattern: str, strict: bool) -> Column:
    """Structs (start, end, kind, strict, value) of a pattern's matches."""
    return F.transform(
        located(text, pattern),
        lambda m: F.struct(
            m["start"], m["end"], F.lit(kind).alias("kind"),
            (_passes(kind, m["value"]) if strict else F.lit(False)).alias("strict"), m["value"].alias("value"),
        ),
    )


def with_candidates(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``_base`` and ``_more``: spans that are personal data, and those that may be.

    Matches of a strict pattern that fail its check stay among the further candidates if they are
    cards of a fitting length; what overlaps a base span is none.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    has = {
        "email": body.contains("@"), "phone": body.contains("+"), "ip": body.rlike("[0-9]\\.[0-9]"),
        "card": body.rlike("[0-9]{2}|[0-9][\\x20-][0-9]"),
    }
    marks = {"email": body.rlike("(?i)[\\[(](?:at)[\\])]"), "phone": body.rlike("[0-9]{3}[.-][0-9]{4}"), "ssn": body.rlike("[0-9]-[0-9]{2}-[0-9]")}
    strict = {f"_s_{kind}": where_any(has[kind], _found(body, kind, p, True), FOUND) for kind, p in STRICT.items()}
    loose = {f"_l_{kind}": where_any(marks[kind], _found(body, kind, p, False), FOUND) for kind, p in LOOSE.items()}
    found = df.withColumns(strict | loose)
    base = F.concat(*[F.filter(name, lambda s: s["strict"]) for name in strict])
    fits = lambda s: ~s["strict"] & _digits(s["value"]).between(14, 19)
    more = F.concat(F.filter("_s_card", fits), *[F.col(name) for name in loose])
    found = found.withColumns({"_base": in_order(base, KINDS), "_maybe": more}).drop(*strict, *loose)
    apart = lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return found.withColumn("_more", in_order(F.filter("_maybe", apart), KINDS)).drop("_maybe")


def _seen(span: Column, text: Column) -> Column:
    """Votes (-1, 0 or 1) and features of a span."""
    kind, value = span["kind"], span["value"]
    left = text.substr(F.greatest(span["start"] - LEFT_CHARS + 1, F.lit(1)), F.least(span["start"], F.lit(LEFT_CHARS)))
    before, after = F.right(left, F.lit(1)), text.substr(span["end"] + 1, F.lit(1))
    of_kind = lambda patterns, on: reduce(
        lambda found, kind_pattern: found.when(kind == kind_pattern[0], on.rlike(kind_pattern[1])),
        list(patterns.items())[1:], F.when(kind == next(iter(patterns)), on.rlike(next(iter(patterns.values())))),
    )
    vote = lambda yes, otherwise: F.when(yes, 1).otherwise(otherwise)
    sort = lambda c: F.when(c == "", "none").when(c.rlike("\\s"), "space").when(c.rlike("[\\p{L}\\p{N}]"), "word").otherwise("mark")
    listed, announced = of_kind(GAZETTEER, value), of_kind(CONTEXT, left)
    embedded = (sort(before) == "word") | (sort(after) == "word")
    size = F.least(F.floor(F.length(value) / 4), F.lit(10)).cast("string")
    return F.struct(
        vote(span["strict"], -1).alias("pattern"), vote(listed, -1).alias("gazetteer"), vote(announced, 0).alias("context"),
        F.when(embedded, -1).otherwise(1).alias("border"), F.when((F.length(value) <= FILLER_CHARS) & value.rlike(FILLER), -1).otherwise(0).alias("filler"),
        span["strict"].cast("string").alias("strict"), size.alias("size"), sort(before).alias("left"),
        sort(after).alias("right"), announced.cast("string").alias("announced"), listed.cast("string").alias("listed"),
    )


def with_evidence(df: DataFrame, text: str) -> DataFrame:
    """Give every span of ``_base`` and ``_more`` its votes and features as ``seen``."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    add = lambda s: F.struct(s["start"], s["end"], s["kind"], s["value"], _seen(s, body).alias("seen"))
    return df.withColumns({name: F.transform(name, add) for name in ("_base", "_more")})


@dataclass
class SpanModel:
    prior: dict[str, float]  # log-odds per kind
    weights: dict[str, float]  # log-odds per kind, feature and value
    reliability: dict[str, tuple[float, float]]  # per labeler: chance of a right vote on true, on false spans


def learn_spans(df: DataFrame) -> SpanModel:
    """Learn from the counted votes and features of all candidates of ``with_evidence``.

    What comes to the driver is one row per combination of kind, votes and features that occurs: all
    are categories with a few fixed values, so their number does not grow with the documents.
    """
    spans = df.select(F.explode(F.concat("_base", "_more")).alias("s")).select("s.kind", "s.seen.*")
    cases = [(row, row["count"]) for row in spans.groupBy(*spans.columns).count().collect()]
    right = {name: [0.8, 0.8] for name in VOTES}
    prior = defaultdict(lambda: 0.5)
    belief = [0.5] * len(cases)
    for _ in range(ROUNDS):
        for i, (row, _) in enumerate(cases):
            odds = math.log(prior[row["kind"]] / (1 - prior[row["kind"]]))
            for name in VOTES:
                true, false = right[name]
                if row[name] > 0:
                    odds += math.log(true / (1 - false))
                elif row[name] < 0:
                    odds += math.log((1 - true) / false)
            belief[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        for name in VOTES:
            hits = [1.6, 0.4, 1.6, 0.4]  # right and wrong on true spans, right and wrong on false ones
            for (row, many), q in zip(cases, belief, strict=True):
                if row[name]:
                    hits[0 if row[name] > 0 else 1] += q * many
                    hits[3 if row[name] > 0 else 2] += (1 - q) * many
            right[name] = [max(0.5, hits[0] / (hits[0] + hits[1])), max(0.5, hits[2] / (hits[2] + hits[3]))]
        for kind in KINDS:
            own = [(many, q) for (row, many), q in zip(cases, belief, strict=True) if row["kind"] == kind]
            prior[kind] = (1 + sum(n * q for n, q in own)) / (2 + sum(n for n, _ in own))
    sums: dict[tuple[str, str, str], list[float]] = defaultdict(lambda: [0.5, 0.5])
    totals: dict[str, list[float]] = defaultdict(lambda: [1.0, 1.0])
    for (row, many), q in zip(cases, belief, strict=True):
        for side, part in ((0, q * many), (1, (1 - q) * many)):
            totals[row["kind"]][side] += part
            for name in FEATURES:
                sums[row["kind"], name, row[name]][side] += part
    weights = {
        "|".join(key): math.log(yes / totals[key[0]][0]) - math.log(no / totals[key[0]][1]) for key, (yes, no) in sums.items()
    }
    odds = {kind: math.log(yes / no) for kind, (yes, no) in totals.items()}
    return SpanModel(odds, weights, {name: tuple(pair) for name, pair in right.items()})


def _literal_map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in (values or {"": 0.0}).items() for x in pair])


def with_spans(df: DataFrame, model: SpanModel, add_from: float = ADD_FROM) -> DataFrame:
    """Add ``spans``: all base spans, and the further candidates the classifier takes.

    Those overlap no base span and, of several that overlap, the leftmost and then the first kind.
    """
    prior, weights = _literal_map(model.prior), _literal_map(model.weights)
    zero = lambda value: F.coalesce(value, F.lit(0.0))

    def chance(span: Column) -> Column:
        parts = [zero(weights[F.concat_ws("|", span["kind"], F.lit(name), span["seen"][name])]) for name in FEATURES]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, parts, zero(prior[span["kind"]]))))

    plain = lambda s: F.struct(s["start"], s["end"], s["kind"])
    taken = F.transform(F.filter("_more", lambda s: chance(s) >= add_from), plain)
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    first = F.aggregate(
        taken, none,
        lambda kept, s: F.when((F.size(kept) == 0) | (F.element_at(kept, -1)["end"] <= s["start"]), F.concat(kept, F.array(s))).otherwise(kept),
    )
    return df.withColumn("spans", in_order(F.concat(F.transform("_base", plain), first), KINDS))


def personal_data(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: id, base (array of start, end, kind) and spans, base ones included.

    A null text counts as empty and has no span. Repeated rows and ids, null ids and other columns
    change nothing. The model is learned from all rows of ``df``; the texts are read once for it and
    once for the result. Positions are code points, ends exclusive.
    """
    rows = picked(df, id=id, text=text)
    seen = with_evidence(with_candidates(rows, "text"), "text").drop("text")
    seen = staged(seen, "span-candidates")
    plain = lambda s: F.struct(s["start"], s["end"], s["kind"])
    found = with_spans(seen, learn_spans(seen))
    return found.select(F.col("id").alias(id), F.transform("_base", plain).alias("base"), "spans")


def redacted(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with each personal span of its text replaced by its kind in angle brackets.

    Overlapping spans are replaced as one, by the kind of the first. Texts without spans, null ones
    included, and all other columns stay as they are.
    """
    rows = df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    seen = with_evidence(with_candidates(rows, "_text"), "_text")
    model = learn_spans(seen.select("_base", "_more"))
    found = with_spans(seen, model)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    cut = F.aggregate(
        "spans", start,
        lambda done, s: F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= done["at"],
                F.concat(
                    done["parts"],
                    F.array(F.col("_text").substr(done["at"] + 1, s["start"] - done["at"]), F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))),
                ),
            ).otherwise(done["parts"]).alias("parts"),
        ),
        lambda done: F.concat(F.array_join(done["parts"], ""), F.col("_text").substr(done["at"] + 1, F.length("_text"))),
    )
    clean = F.when(F.size("spans") > 0, cut).otherwise(F.col("_text"))
    return found.select(F.col("_row").withField(f"`{text}`", clean).alias("_row")).select("_row.*")
