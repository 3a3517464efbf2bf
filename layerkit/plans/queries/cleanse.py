"""Loads and cleansing."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerkit.functions import (
    code_label,
    int_to_date,
    key_prefix,
    key_suffix,
    or_default,
    to_day,
    trimmed,
)
from layerkit.operators.dedupe import keep_latest
from layerkit.plans.queries.data import RAW_ORDERS_SQL, RAW_PARTS_SQL, raw_orders, raw_parts, table
from layerkit.session import new_path
from layerkit.sources.csv import read_csv, write_csv
from layerkit.streaming.ingest import ingest_csv

STATUS = {"O": "Open", "F": "Filled"}


def bronze_csv_roundtrip(spark, sf):
    rows = table(spark, sf, "customer")
    path = new_path(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


def bronze_csv_multiline(spark, sf):
    """Orders with line breaks, quotes and commas in a cell, through one CSV file."""
    note = F.concat("o_orderstatus", F.lit('\n"'), "o_orderpriority", F.lit('",\r\n\n'), "o_custkey")
    rows = table(spark, sf, "orders").select("o_orderkey", note.alias("note"), "o_totalprice")
    path = new_path(spark, "csv")
    write_csv(rows.coalesce(1), path)
    return read_csv(spark, path, rows.schema, multi_line=True)


def stream_csv_ingest(spark, sf):
    rows = table(spark, sf, "supplier")
    path = new_path(spark, "drop")
    write_csv(rows, f"{path}/in")
    ingest_csv(spark, f"{path}/in", rows.schema, f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/out")


def silver_keep_latest(spark, sf):
    latest = keep_latest(table(spark, sf, "events"), ["user_id"], "ts", ["event_id"])
    return latest.select("user_id", "event_id", "ts", "event_type", "value")


def silver_keep_latest_many(spark, sf):
    """Several key columns, many ties in the ordering column."""
    rows = table(spark, sf, "lineitem")
    ties = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    return keep_latest(rows, ["l_orderkey", "l_linenumber"], "l_quantity", ties).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )


def silver_code_labels(spark, sf):
    return raw_orders(spark, sf).select(
        "o_orderkey", "raw_status", code_label("raw_status", STATUS).alias("status_label")
    )


def silver_key_split(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        key_prefix("o_orderpriority", 5).alias("priority_id"),
        key_suffix("o_orderpriority", 3).alias("priority_name"),
    )


def silver_int_dates(spark, sf):
    return raw_orders(spark, sf).select("o_orderkey", "raw_date", int_to_date("raw_date").alias("order_date"))


def silver_null_default(spark, sf):
    return raw_parts(spark, sf).select("p_partkey", or_default("raw_price", 0.0).alias("price"))


def silver_ts_to_date(spark, sf):
    return table(spark, sf, "events").select("event_id", to_day("ts").alias("event_day"))


def silver_trim_dims(spark, sf):
    return raw_parts(spark, sf).select(
        "p_partkey",
        trimmed("raw_name").alias("p_name"),
        trimmed("raw_brand").alias("p_brand"),
        F.length("raw_name").cast("bigint").alias("raw_length"),
    )


QUERIES = {
    "bronze_csv_roundtrip": bronze_csv_roundtrip,
    "bronze_csv_multiline": bronze_csv_multiline,
    "stream_csv_ingest": stream_csv_ingest,
    "silver_keep_latest": silver_keep_latest,
    "silver_keep_latest_many": silver_keep_latest_many,
    "silver_code_labels": silver_code_labels,
    "silver_key_split": silver_key_split,
    "silver_int_dates": silver_int_dates,
    "silver_null_default": silver_null_default,
    "silver_ts_to_date": silver_ts_to_date,
    "silver_trim_dims": silver_trim_dims,
}

SQL = {
    "bronze_csv_roundtrip": "SELECT * FROM customer",
    "bronze_csv_multiline": """
        SELECT o_orderkey, o_totalprice,
               o_orderstatus || chr(10) || '"' || o_orderpriority || '",' || chr(13) || chr(10) || chr(10) || o_custkey AS note
        FROM orders""",
    "stream_csv_ingest": "SELECT * FROM supplier",
    "silver_keep_latest": """
        SELECT user_id, event_id, ts, event_type, value FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id) AS flag_last
          FROM events WHERE user_id IS NOT NULL) t
        WHERE flag_last = 1""",
    "silver_keep_latest_many": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM (
          SELECT *, row_number() OVER (
              PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_quantity DESC NULLS FIRST, l_shipdate NULLS LAST, l_partkey NULLS LAST,
                       l_suppkey NULLS LAST, l_extendedprice NULLS LAST) AS flag_last
          FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) t
        WHERE flag_last = 1""",
    "silver_code_labels": f"""
        SELECT o_orderkey, raw_status,
               CASE upper(trim(raw_status)) WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' ELSE 'n/a' END AS status_label
        FROM ({RAW_ORDERS_SQL}) r""",
    "silver_key_split": """
        SELECT o_orderkey,
               replace(substring(o_orderpriority, 1, 5), '-', '_') AS priority_id,
               substring(o_orderpriority, 3, length(o_orderpriority)) AS priority_name
        FROM orders""",
    "silver_int_dates": f"""
        SELECT o_orderkey, raw_date,
               CASE WHEN raw_date = 0 OR length(CAST(raw_date AS VARCHAR)) <> 8 THEN NULL
                    ELSE CAST(strptime(CAST(raw_date AS VARCHAR), '%Y%m%d') AS DATE) END AS order_date
        FROM ({RAW_ORDERS_SQL}) r""",
    "silver_null_default": f"SELECT p_partkey, coalesce(raw_price, 0.0) AS price FROM ({RAW_PARTS_SQL}) r",
    "silver_ts_to_date": "SELECT event_id, CAST(ts AS DATE) AS event_day FROM events",
    "silver_trim_dims": f"""
        SELECT p_partkey, trim(raw_name) AS p_name, trim(raw_brand) AS p_brand,
               CAST(length(raw_name) AS BIGINT) AS raw_length
        FROM ({RAW_PARTS_SQL}) r""",
}
