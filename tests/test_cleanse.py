import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerkit import functions as L


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column.alias("x")).first().x


def test_trim_strips_spaces_only(spark):
    assert one(spark, L.trimmed("c"), "  \tAnn \t ") == "\tAnn \t"


@pytest.mark.parametrize("raw, want", [(" s ", "Single"), ("M", "Married"), ("", "n/a"), ("X", "n/a"), (None, "n/a")])
def test_code_label(spark, raw, want):
    assert one(spark, L.code_label("c", {"S": "Single", "M": "Married"}), raw) == want


def test_code_label_without_labels(spark):
    assert one(spark, L.code_label("c", {}, "none"), "a") == "none"


def test_key_split(spark):
    assert one(spark, L.key_prefix("c", 5), "CO-RF-FR-R92B-58") == "CO_RF"
    assert one(spark, L.key_suffix("c", 7), "CO-RF-FR-R92B-58") == "FR-R92B-58"
    assert one(spark, L.key_suffix("c", 7), "short") == ""


def test_defaults_and_fallback(spark):
    assert one(spark, L.or_default("c", 0), None, "int") == 0
    df = spark.createDataFrame([("Male", "Female"), ("n/a", "Female"), ("n/a", None), (None, "Male")], "a string, b string")
    got = [r.x for r in df.select(L.prefer("a", "b").alias("x")).collect()]
    assert got == ["Male", "Female", "n/a", "Male"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_int_dates(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [(20110101,), (0,), (32154,), (None,), (123456789,), (-2011010,)]
        df = spark.createDataFrame(rows, "c int")
        got = [r.x for r in df.select(L.int_to_date("c", "null").alias("x")).collect()]
        assert got == [dt.date(2011, 1, 1), None, None, None, None, None]
        bad = spark.createDataFrame([(20231301,), (20230230,)], "c int")
        assert [r.x for r in bad.select(L.int_to_date("c", "null").alias("x")).collect()] == [None, None]
        with pytest.raises(Exception, match="not a yyyymmdd date"):
            bad.select(L.int_to_date("c").alias("x")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    with pytest.raises(ValueError):
        L.int_to_date("c", "skip")


def test_times(spark):
    row = spark.range(1).select(
        L.loaded_at().alias("at"),
        L.report_time(F.lit(dt.datetime(2024, 1, 2, 3, 4, 5))).alias("text"),
        L.to_day(F.lit("2024-01-02 23:59:59").cast("timestamp_ntz")).alias("day"),
    )
    assert row.schema["at"].dataType.simpleString() == "timestamp_ntz"
    assert row.first().text == "2024-01-02 03:04:05" and row.first().day == dt.date(2024, 1, 2)
