"""Every registered query against its SQL, run by DuckDB on the same tables."""

import datetime as dt
import math
import os
from collections import Counter

import pytest

import __spark_entry__ as driver
from layerkit.operators import joins
from layerkit.plans.queries import all_queries

duckdb = pytest.importorskip("duckdb")

# the queries of the corpus operators have tests of their own
QUERIES = {n: q for n, q in driver.queries().items() if n in all_queries()}
SQL = {n: q for n, q in driver.oracle_sql().items() if n in all_queries()}


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for file in os.listdir(sf):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{file}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    answer = duck.execute(SQL[name])
    names = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(names)
    got, want = bag(df.columns, df.collect()), bag(names, answer.fetchall())
    assert sum(want.values()) > 0
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and "customer_key" in df.columns


@pytest.mark.parametrize("name", ["gold_fact", "retail_fact_sales", "dq_orphan_facts", "dq_orphan_anti"])
def test_query_equals_sql_when_nothing_is_small_enough_to_broadcast(spark, sf, duck, name, monkeypatch):
    for join in (joins.left_join, joins.left_anti_join):
        monkeypatch.setitem(join.__kwdefaults__, "broadcast_bytes", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[name](spark, sf)
        got = bag(df.columns, df.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    answer = duck.execute(SQL[name])
    assert got == bag([d[0] for d in answer.description], answer.fetchall())
