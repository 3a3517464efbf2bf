import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from layerkit.operators.profile import (
    profile_columns,
    profile_numeric,
    profile_overview,
    profile_string,
    profile_top_values,
)
from layerkit.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_exact_quantiles_equal_numpy(spark, accuracy):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.normal(size=5_000), "b": rng.integers(0, 4, 5_000).astype(float)})
    pdf.loc[::3, "b"] = 2.0
    df = spark.createDataFrame(pdf).withColumn("c", F.when(F.col("a") > 0, F.col("a")))
    probabilities = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = exact_quantiles(df.repartition(7), ["a", "b", "c"], probabilities, accuracy)
    for c, values in {"a": pdf.a, "b": pdf.b, "c": pdf.a[pdf.a > 0]}.items():
        assert [got[c][p] for p in probabilities] == pytest.approx(np.quantile(values, probabilities))


def test_exact_quantiles_of_one_value_and_of_nothing(spark):
    df = spark.range(100).select(F.lit(3.5).alias("x"), F.lit(None).cast("double").alias("y"))
    assert exact_quantiles(df, ["x", "y"], [0.5]) == {"x": {0.5: 3.5}, "y": {0.5: None}}


@pytest.mark.parametrize("share", [0.0, 0.3, 0.6, 1.0])
def test_quantiles_with_nan_last(spark, share):
    values = [float("nan") if i < 300 * share else float(i % 97) for i in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, ["x"], probabilities, accuracy=20)["x"]
    ordered = sorted(v for v in values if v == v) + [float("nan")] * round(300 * share)
    for p in probabilities:
        low, high = ordered[int(np.floor(p * 299))], ordered[int(np.ceil(p * 299))]
        part = p * 299 % 1
        assert got[p] == pytest.approx(low + (high - low) * part if part else low, nan_ok=True)


def test_no_progress_is_an_error():
    from layerkit.operators.quantiles import _Rank

    with pytest.raises(ArithmeticError):
        _Rank("x", 3, 10).narrow({})


def test_instants_in_the_hour_set_back_stay_apart(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_seconds(s) AS at FROM VALUES (1730611800), (1730615400) t(s)")
        row = profile_columns(df).first()
        assert (row.n_distinct, row.is_unique) == (2, True)
        assert profile_top_values(df, ["at"], 5).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_many_top_values(spark):
    df = spark.range(3000).select((F.col("id") % 2000).alias("v"))
    got = profile_top_values(df, ["v"], 1500).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 1501))
    assert sorted(int(r.value) for r in got[:1000]) == list(range(1000))


def test_profile_numeric_counts(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-2.0,), (None,), (1.0,)], "v double")
    row = profile_numeric(df).first()
    assert (row.n, row.n_missing, row.n_distinct, row.n_zeros, row.n_negative) == (5, 1, 3, 1, 1)
    assert (row.min, row.max, row.q50, row.is_unique) == (-2.0, 1.0, 0.5, False)
    assert row.std == pytest.approx(np.std([1, 0, -2, 1], ddof=1))


def test_profile_approximate_needs_one_scan(spark, explained):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y")], "v double, s string")
    row = profile_numeric(df, exact=False).first()
    assert row.q50 == 1.0 and row.n_distinct == 2 and row.is_unique is None
    assert profile_string(df, exact=False).first().median_length == 1.0


def test_profile_string_long_values_stay_apart(spark):
    df = spark.createDataFrame([("a" * 100 + "1",), ("a" * 100 + "2",), ("",)], "s string")
    row = profile_string(df).first()
    assert (row.n_distinct, row.is_unique, row.max_length, row.n_empty) == (3, True, 101, 1)
    assert row.median_length == 101.0


def test_profile_columns_and_overview(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", None)], "i int, s string, d date")
    rows = {r.column_name: r for r in profile_columns(df).collect()}
    assert rows["i"].is_unique and not rows["s"].is_unique and rows["d"].n_distinct == 0
    one = profile_overview(df).first()
    assert (one.n, one.n_var, one.n_cells_missing, one.n_vars_all_missing) == (2, 3, 2, 1)
    assert (one.n_numeric, one.n_text, one.n_date) == (1, 1, 1)


def test_top_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "s string")
    got = [(r["rank"], r.value, r.n) for r in profile_top_values(df, ["s"], 2).orderBy("rank").collect()]
    assert got == [(1, "b", 2), (2, "a", 1)]
