import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import jaccard_join, pii, queries

DATA = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "duplicates", "benchmark", "personal", "mixture"]


def test_every_stage_acts_and_keeps_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    bad = [(10**9, "12 34 !!!", "en", "src0", 9), (10**9 + 1, None, None, None, None)]
    items = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").limit(2).collect()]
    bad += [(10**9 + 2, items[0][1], "en", "src1", 1)]  # a copy
    leak = spark.read.parquet(f"{DATA}/benchmark.parquet").orderBy("item_id").first().text
    bad += [(10**9 + 3, f"some words before it {leak} and behind it, mail me at a.b@c.example", "en", "src1", 1)]
    bad += [(10**9 + 4, items[1][1].split("\n")[0] + " reach me at q.r@s.example or 10.20.30.40 today " + "zu " * 9, "en", None, 1)]
    at = docs.unionByName(spark.createDataFrame(bad, docs.schema))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, DATA).cache()
        seen[name] = {r.doc_id for r in out.select("doc_id").collect()}
        if name != "mixture":
            assert out.schema.names == docs.schema.names
        at = out
    total = {r.doc_id for r in docs.select("doc_id").collect()}
    assert not {10**9, 10**9 + 1} & seen["language"] and len(total - seen["language"]) <= 1
    assert 10**9 + 2 not in seen["duplicates"] and 10**9 + 3 in seen["duplicates"]
    assert 10**9 + 3 not in seen["benchmark"] and seen["personal"] == seen["benchmark"]
    texts = [r.text for r in at.select("text").distinct().collect()]
    assert not any(s[0] in pii.BASE_KINDS for t in texts for s in pii.spans_of(t))
    assert at.columns == [*docs.columns, "copy"]
    numbered = at.groupBy("doc_id").agg(F.max("copy").alias("m"), F.count("*").alias("n"))
    assert numbered.where("m <> n or m > 3").isEmpty()


def test_run_and_empty_and_odd_tables(spark, odd_docs, no_docs):
    assert corpus_pipeline.run(spark, DATA).count() > 100
    for docs in (no_docs, odd_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, DATA)
            assert set(docs.columns) <= set(out.columns)
            out.collect()


@pytest.mark.parametrize("name", queries.ORACLES)
def test_queries_match_sql(spark, name):
    sql = duckdb.connect()
    sql.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
    want = sql.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_one_document_of_each_class_stays(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    classes = {r.class_id for r in jaccard_join.join(docs).collect()}
    assert {r.doc_id for r in corpus_pipeline.duplicates(spark, docs, DATA).collect()} == classes


def test_columns_that_clash_with_working_names_stay(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    names = ("_language", "_leaks", "_node", "_row", "row", "hits", "language", "rows", "_number", "_document")
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.col("doc_id") + i)
    at = docs
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, DATA)
        assert at.columns[: len(docs.columns)] == docs.columns
    wrong = " or ".join(f"{name} <> doc_id + {i}" for i, name in enumerate(names))
    assert at.count() > 0 and at.where(wrong).isEmpty()
