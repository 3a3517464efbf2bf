import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from layerkit.operators import summaries as S
from layerkit.operators.profile import profile_top_values, profile_top_values_bounded


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"day": np.arange(40_000) % 10, "x": rng.normal(size=40_000), "s": rng.integers(0, 9000, 40_000).astype(str)})
    df = spark.createDataFrame(pdf).withColumn("x", F.when(F.col("s") != "7", F.col("x")))
    return df.withColumn("nothing", F.lit(None).cast("double")).cache()


COLUMNS = ("x", "s", "nothing")


def test_ten_loads_merge_to_the_summary_of_one(spark, numbers, tmp_path):
    path = str(tmp_path / "kept")
    for day in range(10):
        S.keep(S.summarise(numbers.where(F.col("day") == day), COLUMNS, "t", F.lit(day)), path)
    # a load that comes again replaces its summary
    S.keep(S.summarise(numbers.where("day = 3"), COLUMNS, "t", F.lit(3)), path)
    parts = {r.column_name: r for r in S.merged(S.kept(spark, path)).collect()}
    whole = {r.column_name: r for r in S.merged(S.summarise(numbers, COLUMNS, "t", F.lit("all"))).collect()}
    for c in COLUMNS:
        a, b = parts[c], whole[c]
        assert (a.loads, b.loads) == (10, 1)
        assert (a.n, a.n_missing, a.min, a.max, a.n_distinct) == (b.n, b.n_missing, b.min, b.max, b.n_distinct)
        assert a.n == 40_000
    assert parts["x"].mean == pytest.approx(whole["x"].mean)
    assert parts["nothing"].n_missing == 40_000 and parts["nothing"].mean is None and parts["nothing"].q50 is None
    assert parts["s"].q50 is None and parts["s"].min is None


def test_sketches_are_as_near_as_they_say(numbers):
    got = {r.column_name: r for r in S.merged(S.summarise(numbers, COLUMNS, "t", F.col("day"))).collect()}
    x = np.sort(numbers.where("x is not null").toPandas()["x"].to_numpy())
    for q, p in S.QUANTILES.items():
        assert abs(np.searchsorted(x, got["x"][q]) / len(x) - p) <= S.RANK_ERROR
    exact = numbers.select("s").distinct().count()
    assert abs(got["s"].n_distinct - exact) <= S.DISTINCT_ERROR * exact


def test_nan_and_loads_without_a_name(spark):
    df = spark.createDataFrame([(float("nan"), None), (2.0, "a"), (None, "a")], "x double, load string")
    row = S.merged(S.summarise(df, ["x"], "t", F.col("load"))).first()
    assert (row.loads, row.n, row.n_missing, row.n_distinct, row.q50) == (2, 3, 1, 2, 2.0)


def test_no_columns_is_an_error(numbers):
    with pytest.raises(ValueError):
        S.summarise(numbers, [], "t", F.lit(1))


@pytest.mark.parametrize("buckets", [2, 64, 4096])
@pytest.mark.parametrize("k", [1, 10])
def test_bounded_top_values_equal_the_plain_ones(spark, buckets, k):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"z": rng.zipf(1.3, 20_000) % 5000, "flat": np.arange(20_000), "f": rng.integers(0, 30, 20_000) / 2})
    df = spark.createDataFrame(pdf).withColumn("s", F.when(F.col("flat") % 4 != 0, F.col("z").cast("string")))
    df = df.withColumn("none", F.lit(None).cast("int")).withColumn("two", F.col("flat") % 2 == 0).repartition(5)
    columns = df.columns
    want = sorted(map(tuple, profile_top_values(df, columns, k).collect()))
    assert sorted(map(tuple, profile_top_values_bounded(df, columns, k, buckets).collect())) == want


def test_bounded_top_values_group_few_values(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 4 != 0, F.col("id") % 5).otherwise(F.col("id")).alias("v"))
    got = profile_top_values_bounded(df, ["v"], 5)
    # 0 and 4 are also among the quarter of values that occur once
    assert {(r.value, r.n) for r in got.collect()} == {("0", 15_001), ("4", 15_001), *((v, 15_000) for v in "123")}
