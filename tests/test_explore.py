import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from layerkit.operators import explore as X


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    some = [(rng.choice([None, *range(6)]), rng.random() if rng.random() < 0.9 else None, 7, rng.choice("xyz"), rng.choice(["p", "q", None])) for _ in range(400)]
    return [(a, None if b is None else b + (a or 0), c, d, d if e == "p" else e) for a, b, c, d, e in some]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "a int, `b.c` double, one int, d string, e string").repartition(4)


def found(result, value):
    return {(r["first"], r["second"]): (r[value], r["n"]) for r in result.collect()}


def test_correlations_equal_pandas(df, rows):
    plain = pd.DataFrame(rows, columns=["a", "b.c", "one", "d", "e"])[["a", "b.c", "one"]].astype(float)
    got = found(X.correlations(df), "correlation")
    both = int(plain[["a", "b.c"]].notna().all(axis=1).sum())
    assert got["a", "b.c"] == (pytest.approx(plain["a"].corr(plain["b.c"])), both)
    assert got["a", "one"][0] is None and len(got) == 3
    ranked = plain.rank()
    assert found(X.rank_correlations(df), "correlation")["a", "b.c"][0] == pytest.approx(ranked["a"].corr(ranked["b.c"]))
    assert X.correlations(df.select("a")).count() == 0 and found(X.correlations(df.limit(0)), "correlation")["a", "one"] == (None, 0)


def test_ranks_over_several_partitions(spark):
    values = [i % 37 for i in range(1000)] + [None] * 5
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["value"]: r["rank"] for r in X.ranks(spark.createDataFrame([(v,) for v in values], "v int"), "v").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = pd.Series([v for v in values if v is not None]).rank()
    assert got == {v: want[values.index(v)] for v in range(37)}


def test_associations_by_hand(df, rows):
    pairs = [(d, e) for *_, d, e in rows if e is not None]
    table = pd.crosstab(pd.Series([d for d, _ in pairs]), pd.Series([e for _, e in pairs])).to_numpy()
    expected = table.sum(axis=1, keepdims=True) * table.sum(axis=0, keepdims=True) / table.sum()
    chi = ((table - expected) ** 2 / expected).sum()
    want = np.sqrt(chi / table.sum() / (min(table.shape) - 1))
    assert found(X.associations(df), "cramers_v") == {("d", "e"): (pytest.approx(want), len(pairs))}
    fixed = df.select("d", F.lit("k").alias("k"))
    assert found(X.associations(fixed), "cramers_v")["d", "k"][0] is None


def test_histograms(spark, df, rows):
    got = X.histograms(df, ["a", "b.c", "one"], 5).orderBy("column_name", "bin").collect()
    for name, values in (("a", [r[0] for r in rows]), ("b.c", [r[1] for r in rows])):
        known = np.array([v for v in values if v is not None], float)
        counts, edges = np.histogram(known, 5)
        mine = [r for r in got if r["column_name"] == name]
        assert [r["n"] for r in mine] == counts.tolist()
        assert [r["lower"] for r in mine] + [mine[-1]["upper"]] == pytest.approx(edges.tolist())
    assert [(r["bin"], r["lower"], r["upper"], r["n"]) for r in got if r["column_name"] == "one"] == [(0, 7.0, 7.0, len(rows))]
    odd = spark.createDataFrame([(float("nan"), None), (1.0, None), (3.0, None)], "x double, y double")
    assert [(r["column_name"], r["n"]) for r in X.histograms(odd, bins=2).orderBy("bin").collect()] == [("x", 1), ("x", 1)]


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 1), (2, 3), (2, 3), (2, 3), (None, None)], "`x.y` int, z int")
    assert sorted(map(tuple, X.repeated_rows(df).collect())) == [(1, None, 2), (2, 3, 3)]
    assert X.repeated_rows(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        X.repeated_rows(df.withColumn("copies", F.lit(1)))
