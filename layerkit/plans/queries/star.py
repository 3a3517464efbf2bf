"""Dimensions with surrogate keys, and the fact table."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerkit.functions import prefer
from layerkit.operators.dedupe import current_rows
from layerkit.operators.joins import Measurement, left_join
from layerkit.operators.keys import stable_key, surrogate_key
from layerkit.plans.queries.data import RAW_PARTS_SQL, raw_parts, table
from layerkit.session import new_path, store
from layerkit.sources.tables import publish_view


def gold_current_rows(spark, sf):
    """Line items valid until further notice: open lines have no end date."""
    lines = table(spark, sf, "lineitem").withColumn(
        "end_date", F.when(F.col("l_linestatus") != "O", F.col("l_shipdate"))
    )
    return current_rows(lines, "end_date").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


def gold_dim_customer(spark, sf):
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    joined = left_join(customer, nation, "c_nationkey", "n_nationkey")
    joined = left_join(joined, region, "n_regionkey", "r_regionkey")
    segment = F.when(F.col("c_mktsegment") == "FURNITURE", "n/a").otherwise(F.col("c_mktsegment"))
    rows = joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_number"),
        F.col("n_name").alias("country"),
        prefer(segment, "r_name").alias("segment"),
    )
    return surrogate_key(rows, ["customer_id"], ["customer_number"], "customer_key")


LATER_SEGMENT = "BUILDING"


def gold_dim_customer_refresh(spark, sf):
    """Customers loaded twice: first those outside one segment, then all of them. Who was there keeps the key."""
    register = new_path(spark, "register")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    early = customers.where(F.coalesce(F.col("c_mktsegment") != LATER_SEGMENT, F.lit(True)))
    first = stable_key(early, ["c_custkey"], ["c_name"], register, 1, "customer_key")
    first = store(first.select("customer_key", F.col("c_custkey").alias("early_custkey")), "first")
    second = stable_key(customers, ["c_custkey"], ["c_name"], register, 2, "customer_key")
    kept = second.withColumnRenamed("customer_key", "key").join(first, F.col("c_custkey") == F.col("early_custkey"), "left")
    return kept.select(F.col("key").alias("customer_key"), "c_custkey", F.col("customer_key").alias("first_key"))


def gold_dim_product(spark, sf):
    parts = raw_parts(spark, sf)
    kinds = parts.where("p_type <> 'PROMO'").select(F.col("p_type").alias("kind_id")).distinct()
    kinds = kinds.withColumn("category", F.lower("kind_id"))
    joined = left_join(current_rows(parts, "end_date"), kinds, "p_type", "kind_id")
    rows = joined.select(
        F.col("p_partkey").alias("product_id"),
        F.trim("raw_name").alias("product_name"),
        F.col("p_type").alias("category_id"),
        "category",
        F.coalesce("raw_price", F.lit(0.0)).alias("cost"),
        F.col("p_size").alias("size"),
    )
    return surrogate_key(rows, ["size", "product_id"], ["product_name"], "product_key")


def sales(spark, sf):
    """Line items with the customer and date of their order."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice"
    )
    return left_join(lines, orders, "l_orderkey", "o_orderkey")


def fact(sold, products, customers):
    """The fact table from the stored `sales`."""
    product = products.select("product_id", "product_key")
    customer = customers.select("customer_id", "customer_key")
    keys = Measurement(sold, "l_partkey", "o_custkey")
    joined = left_join(sold, product, "l_partkey", "product_id", hot_from=keys)
    joined = left_join(joined, customer, "o_custkey", "customer_id", hot_from=keys)
    return joined.select(
        F.col("l_orderkey").alias("order_number"),
        F.col("l_linenumber").alias("line"),
        "product_key",
        "customer_key",
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("shipping_date"),
        F.col("l_extendedprice").alias("sales_amount"),
        F.col("l_quantity").alias("quantity"),
    )


def gold_fact(spark, sf):
    return fact(store(sales(spark, sf), "sales"), gold_dim_product(spark, sf), gold_dim_customer(spark, sf))


DIM_CUSTOMER_SQL = """
  SELECT CAST(row_number() OVER (ORDER BY c_custkey NULLS LAST, c_name NULLS LAST) AS BIGINT) AS customer_key,
         c_custkey AS customer_id, c_name AS customer_number, n_name AS country,
         CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment ELSE coalesce(r_name, 'n/a') END AS segment
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
"""

DIM_PRODUCT_SQL = f"""
  SELECT CAST(row_number() OVER (ORDER BY p_size NULLS LAST, p_partkey NULLS LAST) AS BIGINT) AS product_key,
         p_partkey AS product_id, trim(raw_name) AS product_name, p_type AS category_id,
         category, coalesce(raw_price, 0.0) AS cost, p_size AS size
  FROM ({RAW_PARTS_SQL}) p
  LEFT JOIN (SELECT DISTINCT p_type AS kind_id, lower(p_type) AS category FROM part WHERE p_type <> 'PROMO') k
    ON p_type = kind_id
  WHERE end_date IS NULL
"""

FACT_SQL = f"""
  SELECT l_orderkey AS order_number, l_linenumber AS line, product_key, customer_key,
         CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS shipping_date,
         l_extendedprice AS sales_amount, l_quantity AS quantity
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN ({DIM_PRODUCT_SQL}) pr ON l_partkey = pr.product_id
  LEFT JOIN ({DIM_CUSTOMER_SQL}) cu ON o_custkey = cu.customer_id
"""

def gold_view(spark, sf):
    """Current line items published as a view and read by its name."""
    publish_view(gold_current_rows(spark, sf), "gold.current_lines")
    return spark.table("gold_current_lines").where("l_shipdate IS NOT NULL")


QUERIES = {
    "gold_view": gold_view,
    "gold_current_rows": gold_current_rows,
    "gold_dim_customer": gold_dim_customer,
    "gold_dim_customer_refresh": gold_dim_customer_refresh,
    "gold_dim_product": gold_dim_product,
    "gold_fact": gold_fact,
}

SQL = {
    "gold_view": "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE l_linestatus = 'O' AND l_shipdate IS NOT NULL",
    "gold_current_rows": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM (
          SELECT *, CASE WHEN l_linestatus <> 'O' THEN l_shipdate END AS end_date FROM lineitem) l
        WHERE end_date IS NULL""",
    "gold_dim_customer": DIM_CUSTOMER_SQL,
    "gold_dim_customer_refresh": f"""
        SELECT customer_key, c_custkey, CASE WHEN load = 1 THEN customer_key END AS first_key
        FROM (SELECT c_custkey, load, row_number() OVER (ORDER BY load, c_name NULLS LAST, c_custkey NULLS LAST) AS customer_key
              FROM (SELECT *, CASE WHEN c_mktsegment = '{LATER_SEGMENT}' THEN 2 ELSE 1 END AS load FROM customer) c) k""",
    "gold_dim_product": DIM_PRODUCT_SQL,
    "gold_fact": FACT_SQL,
}
