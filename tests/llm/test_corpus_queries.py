"""Registered queries, and the pipeline run stage by stage."""

import os
from collections import Counter

import pytest

import corpus_pipeline
import __spark_entry__ as driver
from layerkit.llm.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")


def test_all_are_registered():
    found = driver.queries()
    assert set(QUERIES) | {"pipeline"} <= set(found) and set(SQL) <= set(driver.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, name):
    duck = duckdb.connect()
    for file in os.listdir(sf):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf}/{file}')")
    df = driver.queries()[name](spark, sf)
    answer = duck.execute(SQL[name])
    names = sorted(d[0] for d in answer.description)
    order = [[d[0] for d in answer.description].index(n) for n in names]
    assert sorted(df.columns) == names
    want = Counter(tuple(r[i] for i in order) for r in answer.fetchall())
    assert Counter(tuple(r[n] for n in names) for r in df.collect()) == want and want


def test_pipeline_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, ids = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    counts = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        counts.append(docs.count())
        assert {r[0] for r in docs.select("doc_id").collect()} <= ids
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    assert len(ids) >= counts[0] > counts[1] >= counts[2] > 0 and counts[3] == counts[4]
    assert corpus_pipeline.run(spark, sf).count() == counts[4]


def test_first_stage_drops_texts_of_unlearnt_languages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("lang IS NOT NULL AND length(text) >= 40")
    strange = ["Это русский текст о погоде и о людях", "qzx vkw jjqp xxzq wwk zzq", "これは日本語の文章です。"]
    rows = [(-1 - i, t, None, "src0", len(t)) for i, t in enumerate(strange)]
    planted = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    kept = {r[0] for r in corpus_pipeline.STAGES[0][1](spark, planted, sf).select("doc_id").collect()}
    clean = {r[0] for r in docs.select("doc_id").collect()}
    assert not kept & {r[0] for r in rows} and len(kept & clean) >= 0.98 * len(clean)
