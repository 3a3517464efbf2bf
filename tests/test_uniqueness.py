import pytest
from pyspark.sql import functions as F

from layerkit.operators import checks as C
from layerkit.operators import uniqueness as U


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def counted(df, keys):
    return rows(df.groupBy(*keys).agg(F.count("*").alias("count")).where(F.col("count") > 1))


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, -1])
def test_repeated_keys_equal_plain_counts(spark, broadcast_bytes):
    df = spark.range(5000).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 4800).alias("a"),
        F.when(F.col("id") % 3 != 0, (F.col("id") % 7).cast("string")).alias("b"),
    ).repartition(6)
    got = U.repeated_keys(df, ["a", "b"], broadcast_bytes=broadcast_bytes, run=300, part=256)
    assert rows(got) == counted(df, ["a", "b"]) and got.count() > 10


def test_one_key_in_all_rows_and_no_rows(spark):
    df = spark.range(3000).select(F.lit(None).cast("string").alias("k"))
    assert rows(U.repeated_keys(df, ["k"], run=100, part=64)) == [(None, 3000)]
    assert rows(U.repeated_keys(df.limit(0), ["k"])) == []


def test_zeros_and_nans_are_one_key_each(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (1.0,)], "x double")
    assert [r["count"] for r in U.repeated_keys(df, ["x"]).collect()] == [2, 2]


def test_few_rows_are_shuffled_for_unique_keys(spark):
    df = spark.range(200_000).select((F.col("id") * 7).alias("k")).repartition(4)
    packed = U.packed_hashes(df, ["k"], 8)
    assert packed.count() <= 4 * 8
    sizes = [len(r.hashes) // 8 for r in packed.collect()]
    assert sum(sizes) == 200_000
    assert U.repeated_hashes(df, ["k"], part=25_000).count() == 0


def test_different_keys_of_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(U.F, "xxhash64", lambda *columns: F.lit(5).cast("bigint"))
    df = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    assert rows(U.repeated_keys(df, ["k"])) == [(2, 2)]


def test_check_of_a_near_unique_key(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    plain = C.DuplicateCheck(name="d", table="t", keys=["k"])
    quick = C.DuplicateCheck(name="d", table="t", keys=["k"], near_unique=True)
    one, other = (C.check_results(spark, [c], {"t": df}).collect() for c in (plain, quick))
    assert one == other and (one[0].total_records, one[0].issues_found) == (5, 2)
    assert rows(C.issue_rows(spark, quick, {"t": df})) == rows(C.issue_rows(spark, plain, {"t": df}))
