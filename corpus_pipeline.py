"""Corpus pipeline: toxicity filter, exact dedup, near-duplicate filter, redaction, packing.

Each stage gets the documents its predecessor kept, written and read again as Parquet, and all but
the last return the columns of ``documents``. An empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.common import id_remainder, labels, staged_texts, unused
from zonecast.llm.exact_dedup import drop_exact_copies
from zonecast.llm.near_duplicates import one_per_component
from zonecast.llm.packing import pack
from zonecast.llm.personal_data import redacted
from zonecast.llm.queries import TOXIC_FROM, word_vocabulary
from zonecast.llm.toxicity import fit_toxicity, with_toxicity
from zonecast.session import new_stage_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold; the labels of ids the query holds out are not used."""
    model = fit_toxicity(docs, labels(spark, sf_dir), id_remainder(F.col("doc_id"), 3) != 1)
    score = unused(docs, "_score")
    return staged_texts(with_toxicity(docs, model, score).where(F.col(score) < TOXIC_FROM).drop(score), "clean")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts, that with the largest id."""
    return drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near copies, that with the smallest id."""
    return one_per_component(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` is that of the text as it is now."""
    found = redacted(docs)
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their ids and places."""
    return pack(docs, word_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("personal_data", redact),
    ("packing", pack_documents),
]

#: Scoring, redaction by a learned classifier and tokenization have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_stage_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
