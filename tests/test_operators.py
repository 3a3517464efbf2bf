import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from layerkit.operators.dedupe import current_rows, keep_latest
from layerkit.operators.joins import Measurement, _hot_salts, hot_values, left_anti_join, left_join, size_in_bytes
from layerkit.operators.keys import stable_key, surrogate_key


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def skewed(spark, n=30_000):
    """A third of the rows carry key 7, a tenth have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 997)
    return spark.range(n).select(F.col("id"), key.cast("bigint").alias("k"))


def test_keep_latest_null_date_wins_and_null_key_dropped(spark):
    df = spark.createDataFrame(
        [
            (1, dt.date(2024, 1, 1), "old"),
            (1, dt.date(2024, 2, 1), "new"),
            (2, dt.date(2024, 1, 1), "dated"),
            (2, None, "undated"),
            (3, dt.date(2024, 1, 1), "b"),
            (3, dt.date(2024, 1, 1), "a"),
            (None, dt.date(2024, 1, 1), "nokey"),
        ],
        "id int, d date, tag string",
    )
    got = {r.id: r.tag for r in keep_latest(df, ["id"], "d", ["tag"]).collect()}
    assert got == {1: "new", 2: "undated", 3: "a"}


def test_keep_latest_cuts_groups_before_the_shuffle(spark, explained):
    plan = explained(keep_latest(skewed(spark), ["k"], "id", ["id"]))
    assert plan.count("WindowGroupLimit") >= 2


def test_keep_latest_one_row_per_key(spark):
    df = skewed(spark)
    out = keep_latest(df, ["k"], "id", ["id"])
    want = df.where("k is not null").groupBy("k").agg(F.max("id").alias("id")).select("id", "k")
    assert rows(out) == rows(want)


def test_current_rows(spark):
    df = spark.createDataFrame([(1, None), (2, dt.date(2024, 1, 1))], "id int, e date")
    assert [r.id for r in current_rows(df, "e").collect()] == [1]


@pytest.mark.parametrize("partitions", ["1", "8", "50"])
def test_surrogate_key_equals_global_row_number(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = skewed(spark, 20_000).withColumn("s", F.concat(F.lit("k"), F.col("k").cast("string")))
        got = surrogate_key(df, ["s"], ["id"], "sk")
        order = [F.col("s").asc_nulls_last(), F.col("id").asc_nulls_last()]
        want = df.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("sk"), "*")
        assert got.schema["sk"].dataType.simpleString() == "bigint"
        assert rows(got) == rows(want)
        assert rows(got) == rows(got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_surrogate_key_survives_split_part_files(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "700")
    try:
        got = surrogate_key(skewed(spark, 5_000), ["k"], ["id"], "sk")
        keys = [r.sk for r in got.orderBy(F.col("k").asc_nulls_last(), "id").collect()]
        assert keys == list(range(1, 5_001))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_surrogate_key_spreads_copies_of_one_row(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
        got = surrogate_key(df, ["k"], [], "sk")
        assert got.agg(F.count_distinct("sk"), F.min("sk"), F.max("sk")).first()[:] == (40_000, 1, 40_000)
        files = got.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        assert files < 40_000 / 5
        keys = [r.k for r in got.orderBy("sk").collect()]
        assert keys == sorted(keys)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_surrogate_key_of_nothing(spark):
    assert surrogate_key(skewed(spark, 10).where("id < 0"), ["k"], ["id"]).collect() == []


def test_surrogate_key_refuses_its_own_column_names(spark):
    for name in ("_at", "_Row", "surrogate_key"):
        with pytest.raises(ValueError, match=name.lower()):
            surrogate_key(spark.range(3).withColumn(name, F.lit(1)), ["id"], [])


def test_surrogate_key_never_gathers_rows(spark, explained):
    assert "SinglePartition" not in explained(surrogate_key(skewed(spark), ["k"], ["id"]))


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_left_join_equals_plain_join(spark, limit):
    left = skewed(spark)
    right = spark.range(0, 997, 2).select(F.col("id").alias("rk"), (F.col("id") * 10).alias("v"))
    got = left_join(left, right, "k", "rk", broadcast_bytes=limit)
    assert rows(got) == rows(left.join(right, left.k == right.rk, "left"))


def test_left_join_with_a_key_frequent_on_the_right(spark):
    left = spark.range(400).select(F.col("id"), (F.col("id") % 50).alias("k"))
    right = spark.range(6_000).select(
        F.col("id").alias("rid"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("rk"),
    )
    assert list(hot_values(right, "rk", 0.1)) == [7]
    got = left_join(left, right, "k", "rk", broadcast_bytes=0)
    assert rows(got) == rows(left.join(right, left.k == right.rk, "left"))


def test_left_join_with_text_keys_frequent_on_both_sides(spark):
    def side(n, prefix):
        key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 == 0, f"{prefix}only").otherwise(F.col("id").cast("string"))
        return spark.range(n).select(F.col("id").alias(f"{prefix}id"), key.alias(f"{prefix}k"))

    left, right = side(240, "l"), side(300, "r")
    got = left_join(left, right, "lk", "rk", broadcast_bytes=0, hot_share=0.05)
    assert rows(got) == rows(left.join(right, left.lk == right.rk, "left"))


def test_left_join_spreads_frequent_and_null_keys(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = skewed(spark, 60_000)
        right = spark.range(997).select(F.col("id").alias("rk"), F.col("id").alias("v"))

        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        plain = largest(left.join(right, left.k == right.rk, "left"))
        assert largest(left_join(left, right, "k", "rk", broadcast_bytes=0)) < plain * 0.6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_left_anti_join_equals_plain_join(spark, limit):
    left = skewed(spark)
    right = spark.range(3_000).select((F.col("id") % 500).alias("rk"))
    got = left_anti_join(left, right, "k", "rk", broadcast_bytes=limit)
    assert rows(got) == rows(left.join(right, left.k == right.rk, "left_anti"))


def test_left_join_refuses_shared_column_names(spark):
    with pytest.raises(ValueError, match="id"):
        left_join(spark.range(3), spark.range(3), "id", "id")


def test_hot_values_are_the_frequent_ones(spark):
    df = skewed(spark)
    assert hot_values(df, "k", 0.01) == {7: pytest.approx(1 / 3, abs=0.01)}
    assert hot_values(df, "id", 0.01) == {} and hot_values(df.where("id < 0"), "k", 0.01) == {}


def test_rare_keys_are_hot_among_many_partitions(spark):
    key = F.when(F.col("id") % 1100 == 0, -1).otherwise(F.col("id"))
    df = spark.range(220_000).select(key.alias("k"))
    assert hot_values(df, "k", 2 / 20_000) == {-1: pytest.approx(1 / 1100)}


def test_a_key_frequent_on_both_sides_is_spread_on_both(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(6_000).select(F.col("id"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"))
        right = spark.range(60).select(F.col("id").alias("rid"), F.when(F.col("id") % 2 == 0, 7).otherwise(-F.col("id")).alias("rk"))
        got = left_join(left, right, "k", "rk", broadcast_bytes=0)
        sizes = [r["count"] for r in got.where("k = 7").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) >= 3_000 * 30 and max(sizes) < 0.55 * sum(sizes) and len(sizes) > 3
        assert rows(got) == rows(left.join(right, left.k == right.rk, "left"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measurement_finds_what_counting_finds(spark):
    df = skewed(spark).withColumn("t", F.when(F.col("id") % 4 == 0, F.lit("often")).otherwise(F.col("id").cast("string")))
    df = df.withColumn("b", F.encode("t", "utf-8"))
    seen = Measurement(df, "k", "t", "b", share=0.01)
    assert seen.size == size_in_bytes(df)
    for column in seen.columns:
        found, counted = seen.hot(column), hot_values(df, column, 0.01)
        assert list(found) == list(counted) and len(found) == 1
        assert next(iter(found.values())) == pytest.approx(next(iter(counted.values())), abs=0.0025)
    none = Measurement(df.where("id < 0"), "k", "t")
    assert none.size == 0 and none.hot("k") == {} and none.hot("t") == {}
    missing = Measurement(spark.range(500).select(F.lit(None).cast("string").alias("k")), "k")
    assert missing.hot("k") == {}


def test_joins_share_one_measurement(spark):
    left = skewed(spark).withColumn("k2", F.col("id") % 11)
    first = spark.range(997).select(F.col("id").alias("a"), F.col("id").alias("va"))
    second = spark.range(11).select(F.col("id").alias("b"), F.col("id").alias("vb"))
    tracker, group = spark.sparkContext.statusTracker(), f"joins-{id(left)}"
    spark.sparkContext.setJobGroup(group, "joins")
    keys = Measurement(left, "k", "k2")
    joined = left_join(left, first, "k", "a", broadcast_bytes=0, hot_from=keys)
    joined = left_join(joined, second, "k2", "b", broadcast_bytes=0, hot_from=keys)
    # two stages of one aggregate over each of the three tables
    assert len(tracker.getJobIdsForGroup(group)) <= 6
    plain = left.join(first, left.k == first.a, "left").join(second, left.k2 == second.b, "left")
    assert rows(joined) == rows(plain)


@pytest.mark.parametrize("partitions, salts", [("8", 3), ("600", 201)])
def test_salts_grow_with_the_shuffle_partitions(spark, partitions, salts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    df = skewed(spark)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert _hot_salts(Measurement(df, "k"), "k") == {7: salts}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_size_in_bytes_measures_strings(spark):
    df = spark.createDataFrame([("abcd", 1), (None, 2)], "s string, i int")
    assert size_in_bytes(df) == 2 * 16 + 4
    assert size_in_bytes(df.limit(0)) == 0
    assert size_in_bytes(df.select(F.array("i"))) is None


def test_stable_keys_never_change(spark, tmp_path):
    register = str(tmp_path / "register")
    rows = lambda *ids: spark.createDataFrame([(i, f"n{9 - i if i is not None else 0}") for i in ids], "id int, name string")
    first = {r.id: r.k for r in stable_key(rows(3, 1, None, 3), ["id"], ["id"], register, 1, "k").collect()}
    assert first == {1: 1, 3: 2, None: 3}
    second = stable_key(rows(0, 1, 2, 3, 5), ["id"], ["name"], register, 2, "k")
    # new keys only, by name: n4 (5), n7 (2), n9 (0)
    want = {1: 1, 3: 2, 5: 4, 2: 5, 0: 6}
    assert {r.id: r.k for r in second.collect()} == want and second.columns == ["k", "id", "name"]
    again = stable_key(rows(0, 1, 2, 3, 5), ["id"], ["name"], register, 2, "k")
    assert {r.id: r.k for r in again.collect()} == want
    third = stable_key(rows(None, 2), ["id"], ["id"], register, 3, "k")
    assert {r.id: r.k for r in third.collect()} == {None: 3, 2: 5}
    assert stable_key(rows(1).limit(0), ["id"], ["id"], register, 4, "k").count() == 0


def test_stable_keys_of_two_columns(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("a", 1), (None, 1), ("a", None)], "x string, y int")
    got = stable_key(df, ["x", "y"], ["y"], str(tmp_path / "r"), 1, "k")
    assert sorted(((r.x, r.y, r.k) for r in got.collect()), key=repr) == [("a", 1, 1), ("a", None, 3), ("a", None, 3), (None, 1, 2)]
