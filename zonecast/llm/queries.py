"""The dealt operators as queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from zonecast.llm.bpe import bpe_decode, bpe_encode, ids_digest, load_ranks
from zonecast.llm.common import documents, id_remainder, labels
from zonecast.llm.exact_dedup import exact_groups
from zonecast.llm.language import fit_languages, load_pieces, predict_language
from zonecast.llm.lexical import lexical_search
from zonecast.llm.near_duplicates import jaccard_components
from zonecast.llm.packing import pack
from zonecast.llm.personal_data import BASE_KINDS as PERSONAL_KINDS
from zonecast.llm.personal_data import personal_data
from zonecast.llm.quality import fit_quality, quality
from zonecast.llm.secrets import BASE_KINDS as SECRET_KINDS
from zonecast.llm.secrets import secrets
from zonecast.llm.spans import span_text
from zonecast.llm.spelling import spelling_variants
from zonecast.llm.top_k import top_k
from zonecast.llm.toxicity import fit_toxicity, toxicity
from zonecast.llm.url_filter import ALLOW, BLOCK, Rule, filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query(
    "op9_exact_dedup",
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
    g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
    FROM d JOIN g USING (body)
    """,
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe_encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return bpe_decode(encoded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def word_vocabulary() -> str:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), word_vocabulary()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    out = id_remainder(F.col("doc_id"), 3) == 1
    pieces = load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = fit_languages(rows.where(~out), pieces)
    return predict_language(rows, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query("op10_ngram_jaccard")
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def _span_digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    of_kind = lambda kind: F.filter("base", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in kinds]
    return found.select(
        "doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans")
    )


@query("op3_personal_data")
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(personal_data(documents(spark, sf_dir)), PERSONAL_KINDS)


@query("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(secrets(documents(spark, sf_dir)), SECRET_KINDS)


TOXIC_FROM = 0.7


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, out = documents(spark, sf_dir), id_remainder(F.col("doc_id"), 3) == 1
    model = fit_toxicity(rows, labels(spark, sf_dir), ~out)
    return toxicity(rows, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )


GOOD_FROM = 0.3


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, out = documents(spark, sf_dir), id_remainder(F.col("doc_id"), 5) == 0
    model = fit_quality(rows, labels(spark, sf_dir), ~out)
    return quality(rows, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted")
    )


@query(
    "op7_top_k",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
        FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
    ),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
    SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5
    """,
)
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


RULES = [
    Rule("net", "/", BLOCK), Rule("example.net", "/en/", ALLOW), Rule("example.com", "/de/", BLOCK), Rule("org", "/fr/", ALLOW),
]
_RULE_ROWS = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
_HOST = "translate(regexp_extract(coalesce({0}, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(coalesce({0}, ''), '://[^/?#]*([^?#]*)', 1)"


def _plain(url: str) -> str:
    host, path = _HOST.format(url), _PATH.format(url)
    query = f"regexp_extract({url}, '://[^?#]*\\?([^#]*)', 1)"
    kept = f"array_to_string(list_filter(string_split({query}, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)')), '&')"
    host = f"regexp_replace(regexp_replace({host}, ':(80|443)$', ''), '^(www|m)\\.([^.]+\\.)', '\\2')"
    return f"nullif({host}, '') || regexp_replace({path}, '(/index\\.html?|/)$', '') || CASE WHEN {kept} = '' THEN '' ELSE '?' || {kept} END"


@query(
    "op11_url_filter",
    # Absolute canonical links only: the tables hold no link of any kind, the tests cover the others.
    f"""
    WITH RECURSIVE rules(host, path, verdict) AS (VALUES {_RULE_ROWS}),
    p AS (SELECT page_id, url, {_HOST.format('url')} AS host, {_PATH.format('url')} AS path, {_plain('url')} AS node FROM pages),
    links AS (
        SELECT DISTINCT {_plain('url')} AS a, {_plain('link')} AS b, link FROM (
            SELECT url, unnest(regexp_extract_all(html, '<link rel="canonical" href="([^"]*://[^"]*)"', 1)) AS link FROM pages)
    ),
    near AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (
        SELECT DISTINCT node AS start, node FROM p WHERE node IS NOT NULL
        UNION SELECT r.start, n.b FROM reach r JOIN near n ON n.a = r.node
    ),
    ends AS (SELECT node, host, path FROM p UNION SELECT b, {_HOST.format('link')}, {_PATH.format('link')} FROM links),
    fits AS (
        SELECT e.node, e.host, e.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
        FROM ends e JOIN rules r ON (e.host = r.host OR ends_with(e.host, '.' || r.host)) AND starts_with(e.path, r.path) GROUP BY ALL
    ),
    decided AS (SELECT r.start, bool_or(f.verdict = 'allow') AS allowed FROM reach r JOIN fits f ON f.node = r.node GROUP BY r.start)
    SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, CASE WHEN NOT d.allowed THEN 'block' END, 'allow') AS verdict
    FROM p LEFT JOIN fits f ON f.node = p.node AND f.host = p.host AND f.path = p.path LEFT JOIN decided d ON d.start = p.node
    """,
)
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


_TERMS = (
    "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)


@query(
    "op12_lexical_search",
    f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS doc, {_TERMS.format('text')} AS terms FROM documents),
    sized AS (SELECT doc, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
    totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sized),
    wanted AS (SELECT DISTINCT item, item_id, unnest(terms) AS term FROM (
        SELECT row_number() OVER () AS item, item_id, {_TERMS.format('text')} AS terms FROM benchmark)),
    tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM sized)
        WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
    weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM tf, totals GROUP BY term),
    measured AS (SELECT doc, doc_id, 50 + (50 * n * docs) // words AS m FROM sized, totals),
    scores AS (SELECT item, item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
        FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN measured USING (doc) GROUP BY item, item_id, doc, doc_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
    SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
    """,
)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))
