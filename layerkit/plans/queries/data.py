"""The given tables, and the raw shapes the cleansing queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_layouts: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. Its layout is taken from the files once per application, since inferring it
    is a job of its own every time."""
    path = f"{sf}/{name}.parquet"
    known = (spark.sparkContext.applicationId, path)
    if known not in _layouts:
        _layouts[known] = spark.read.parquet(path).schema
    return spark.read.schema(_layouts[known]).parquet(path)


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a padded lower-case status and an integer date that is 0 for orders without
    a given priority and lacks the day for urgent ones."""
    priority = F.col("o_orderpriority")
    day = (
        F.when(priority == "4-NOT SPECIFIED", F.lit("0"))
        .when(priority == "1-URGENT", F.date_format("o_orderdate", "yyyyMM"))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        "o_orderdate",
        F.concat(F.lit(" "), F.lower("o_orderstatus"), F.lit(" ")).alias("raw_status"),
        day.cast("int").alias("raw_date"),
    )


RAW_ORDERS_SQL = """
  SELECT o_orderkey, o_orderpriority, o_orderdate,
         ' ' || lower(o_orderstatus) || ' ' AS raw_status,
         CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '0'
                   WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y%m')
                   ELSE strftime(o_orderdate, '%Y%m%d') END AS INTEGER) AS raw_date
  FROM orders
"""


def raw_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with padded texts, no price for one brand, and an end date for large sizes."""
    return table(spark, sf, "part").select(
        "p_partkey",
        "p_size",
        "p_type",
        "p_brand",
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("raw_name"),
        F.concat("p_brand", F.lit("   ")).alias("raw_brand"),
        F.when(F.col("p_brand") != "Brand#7", F.col("p_retailprice")).alias("raw_price"),
        F.when(F.col("p_size") > 40, F.lit("2000-12-31").cast("date")).alias("end_date"),
    )


RAW_PARTS_SQL = """
  SELECT p_partkey, p_size, p_type, p_brand,
         '  ' || p_name || ' ' AS raw_name,
         p_brand || '   ' AS raw_brand,
         CASE WHEN p_brand <> 'Brand#7' THEN p_retailprice END AS raw_price,
         CASE WHEN p_size > 40 THEN DATE '2000-12-31' END AS end_date
  FROM part
"""
