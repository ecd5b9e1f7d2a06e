"""The pipeline: each stage's contract on awkward rows, and the registered queries."""

import os
import random

import pytest

import __spark_entry__ as entry
import cases
import corpus_pipeline
from tagweave.llm import queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def folder(spark, tmp_path):
    texts = [t for _, t in cases.documents() if t]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in cases.documents()] + [
        (None, None, None, None, None), (0, texts[0], "en", "s", 1)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, texts[12])], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.dtypes == docs.dtypes, name
        assert kept.count() <= docs.count()
        docs = kept
    texts = [r["text"] for r in docs.collect()]
    w = cases.words([t for _, t in cases.documents() if t][12])
    assert not any(" ".join(w[:10]) in " ".join(cases.words(t)) for t in texts)
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).collect() == []


def test_stages_keep_clean_documents(spark, folder):
    texts = [f"clean text number {i} with words of its own: {i * 7} {i * 13} {i * 17}"
             for i in range(30)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert sorted(map(tuple, stage(spark, docs, folder).collect())) == rows


def test_stages_keep_columns_of_any_name(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet")
    docs = given.selectExpr("*", "'a' AS N_Lines", "1 AS Found", "2 AS row", "3L AS number",
                            "0.5 AS score", "'x' AS TextHash", "map('k', 1) AS rest")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.dtypes == docs.dtypes, name
        assert {(r["N_Lines"], r["Found"], r["row"], r["number"]) for r in kept.collect()} == {
            ("a", 1, 2, 3)}
    assert stage(spark, docs.limit(0), folder).collect() == []


def test_toxic_labels_alone_drop_nothing(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 1) for i in range(101)],
                                   "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/other/labels.parquet")
    kept = corpus_pipeline.toxic(spark, docs, f"{tmp_path}/other")
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, docs.collect()))


def test_one_row_of_each_group_stays(spark, folder):
    """Also where ids repeat, belong to two groups, or are null."""
    rng = random.Random(3)
    one, two, three, four = (cases.prose(rng, 60, 5000) for _ in range(4))
    given = [(7, one), (7, one), (7, one + " end"), (9, one), (7, two), (8, two),
             (None, three), (None, three + " end"), (None, four), (3, four), (5, ""), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in given], COLUMNS)
    kept = [(r["doc_id"], r["text"]) for r in
            corpus_pipeline.near_duplicates(spark, docs, folder).collect()]
    assert len(kept) == 6 and kept.count((5, "")) == 2
    assert sum(t in (one, one + " end") and i == 7 for i, t in kept) == 1
    assert (7, two) in kept and (None, four) in kept
    assert sum(t in (three, three + " end") for _, t in kept) == 1


def test_names():
    assert [s for s, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near duplicates", "decontamination", "packing"]
    ours = entry.queries()
    assert {n.split("_")[0] for n in ours if n.startswith("op") and n[2].isdigit()} == {
        f"op{i}" for i in range(1, 14)}
    assert ours["pipeline"] is corpus_pipeline.run
    assert set(queries.oracle_sql()) <= set(ours)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = db.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    got = queries.queries()[name](spark, FOLDER).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, result.fetchall()))
