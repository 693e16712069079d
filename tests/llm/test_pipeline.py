"""The queries over the shared tables, and the stages of the pipeline on planted cases."""

from __future__ import annotations

import random

import duckdb
import pytest

import corpus_pipeline
from checks.compare import connect, differences
from zonecast.llm.queries import ORACLES, QUERIES

PLAIN = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "


def test_queries_of_all_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "personal_data", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir).toPandas()
    assert differences(result, connect(sf_dir).sql(ORACLES[name]).df()) == []


def test_stages(spark, sf_dir, tmp_path):
    """Planted copies, near copies and personal data go; clean documents stay as they are."""
    con = duckdb.connect()
    path = f"{sf_dir}/documents.parquet"
    first = con.sql(f"SELECT max(doc_id) + 1 FROM '{path}'").fetchall()[0][0]
    added = [
        (first, PLAIN * 4, "copy"), (first + 1, PLAIN * 4, "copy"), (first + 2, PLAIN * 4 + "end", "near copy"),
        (first + 3, "write to someone@example.com about " + PLAIN, "private"), (first + 4, None, "null"),
    ]
    draw, words = random.Random(1), ["river", "house", "green", "walks", "small", "table"]
    learned = [(first + 10 + i, " ".join([*draw.choices(words, k=30), *(["idiot moron"] if i % 2 else [])]), "en") for i in range(160)]
    added += learned
    table = ", ".join(f"({i}, {'NULL' if t is None else repr(t)}, 'en', {k!r}, {len(t or '')})" for i, t, k in added)
    con.execute(
        f"COPY (SELECT * FROM '{path}' UNION ALL SELECT * FROM (VALUES {table}) v(doc_id, text, lang, source, n_chars)) TO '{tmp_path}/documents.parquet' (FORMAT parquet)"
    )
    known = ", ".join(f"({i}, 1, {int('idiot' in text)})" for i, text, _ in learned)
    con.execute(
        f"COPY (SELECT * FROM '{sf_dir}/labels.parquet' UNION ALL SELECT * FROM (VALUES {known}) v(doc_id, quality, toxic)) TO '{tmp_path}/labels.parquet' (FORMAT parquet)"
    )
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/stage-{k}")
        columns, docs = docs.columns, spark.read.parquet(f"{tmp_path}/stage-{k}")
        kept.append(docs)
        assert k == 4 or docs.columns == columns
    ids = [{r["doc_id"] for r in df.select("doc_id").collect()} for df in kept]
    assert sum(i in ids[0] for i, text, _ in learned if "idiot" in text) <= 4
    assert sum(i not in ids[0] for i, text, _ in learned if "idiot" not in text) <= 4
    scored = QUERIES["op6_toxicity"](spark, str(tmp_path)).where("predicted = 0").collect()
    assert ids[0] == {r["doc_id"] for r in scored}
    assert first not in ids[1] and first + 1 in ids[1]
    assert (first + 1 in ids[2]) and (first + 2 not in ids[2])
    assert ids[0] >= ids[1] >= ids[2] == ids[3] == ids[4]
    text = {r["doc_id"]: r["text"] for r in kept[3].collect()}
    assert text[first + 3].startswith("write to <EMAIL> about one") and text[first + 4] is None
    before = {r["doc_id"]: r["text"] for r in kept[2].collect()}
    assert all(text[i] == before[i] for i in text if "@" not in (before[i] or "") and not any(c.isdigit() for c in before[i] or ""))


def test_stages_take_empty_tables_and_null_or_repeated_ids(spark, sf_dir):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(None, text, 1, "a"), (7, text + " end", 2, "b"), (7, "mail me at x.y@z.org", 3, "c"), (None, None, 4, "d"), (8, "", 5, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node int, _row string")
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, df.where("false"), sf_dir).count() == 0, name
    stages = dict(corpus_pipeline.STAGES)
    once = stages["exact_dedup"](spark, df, sf_dir)
    assert once.columns == df.columns and once.count() == 4  # the null text counts as empty
    near = stages["ngram_jaccard"](spark, df, sf_dir)
    assert sorted(r["node"] for r in near.collect()) == [2, 3, 4, 5]
    clean = {r["node"]: r["text"] for r in stages["personal_data"](spark, df, sf_dir).collect()}
    assert len(clean) == 5 and "x.y@z.org" not in clean[3] and clean[1] == text
    assert stages["packing"](spark, df, sf_dir).where("start = 0").count() == 5
