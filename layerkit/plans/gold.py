"""Star schema of the retail warehouse: silver DataFrames in, dimensions and fact out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.functions import prefer
from layerkit.operators.dedupe import current_rows
from layerkit.operators.joins import Measurement, left_join
from layerkit.operators.keys import surrogate_key


def dim_customers(
    customers: DataFrame, demographics: DataFrame, locations: DataFrame, staging: str | None = None
) -> DataFrame:
    """A key appearing twice in the ERP tables yields two rows; the uniqueness checks report it.
    `staging` is where the key operator keeps its sorted rows."""
    birth = demographics.select(F.col("cid").alias("birth_cid"), "bdate", "gen")
    place = locations.select(F.col("cid").alias("place_cid"), "cntry")
    keys = Measurement(customers, "cst_key")
    joined = left_join(customers, birth, "cst_key", "birth_cid", hot_from=keys)
    joined = left_join(joined, place, "cst_key", "place_cid", hot_from=keys)
    rows = joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("cntry").alias("country"),
        F.col("cst_marital_status").alias("marital_status"),
        prefer("cst_gndr", "gen").alias("gender"),
        F.col("bdate").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"),
    )
    ties = [c for c in rows.columns if c != "customer_id"]
    return surrogate_key(rows, ["customer_id"], ties, "customer_key", staging)


def dim_products(products: DataFrame, categories: DataFrame, staging: str | None = None) -> DataFrame:
    kinds = categories.select(F.col("id").alias("kind_id"), "cat", "subcat", "maintenance")
    joined = left_join(current_rows(products, "prd_end_dt"), kinds, "cat_id", "kind_id")
    rows = joined.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        "maintenance",
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
    )
    order = ["start_date", "product_number"]
    ties = [c for c in rows.columns if c not in order]
    return surrogate_key(rows, order, ties, "product_key", staging)


def fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales with dimension keys; a sale without a match keeps a NULL key."""
    product = products.select("product_number", "product_key")
    customer = customers.select("customer_id", "customer_key")
    keys = Measurement(sales, "sls_prd_key", "sls_cust_id")
    joined = left_join(sales, product, "sls_prd_key", "product_number", hot_from=keys)
    joined = left_join(joined, customer, "sls_cust_id", "customer_id", hot_from=keys)
    return joined.select(
        F.col("sls_ord_num").alias("order_number"),
        "product_key",
        "customer_key",
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
    )


def orphaned_facts(fact: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Facts for which either dimension row is missing, with the ids that were found."""
    customer = customers.select(F.col("customer_key").alias("c_key"), "customer_id")
    product = products.select(F.col("product_key").alias("p_key"), "product_id")
    keys = Measurement(fact, "customer_key", "product_key")
    keyed = fact.select("order_number", "customer_key", "product_key")
    joined = left_join(keyed, customer, "customer_key", "c_key", hot_from=keys)
    joined = left_join(joined, product, "product_key", "p_key", hot_from=keys)
    lost = F.col("customer_id").isNull() | F.col("product_id").isNull()
    return joined.where(lost).select("order_number", "customer_key", "product_key", "customer_id", "product_id")
