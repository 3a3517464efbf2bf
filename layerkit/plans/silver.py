"""Cleansing jobs of the retail warehouse: bronze DataFrame in, silver DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from layerkit.functions import (
    code_label,
    int_to_date,
    key_prefix,
    key_suffix,
    loaded_at,
    or_default,
    to_day,
    trimmed,
)
from layerkit.operators.dedupe import keep_latest

# code labels (fixed values)
MARITAL_STATUS = {"S": "Single", "M": "Married"}
GENDER = {"F": "Female", "M": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}

CATEGORY_ID_LENGTH = 5
PRODUCT_KEY_START = 7


def customers(bronze: DataFrame) -> DataFrame:
    # the source names no tie-break; the whole row makes the choice repeatable
    ties = [c for c in bronze.columns if c not in ("cst_id", "cst_create_date")]
    return keep_latest(bronze, ["cst_id"], "cst_create_date", ties).select(
        "cst_id",
        "cst_key",
        trimmed("cst_firstname").alias("cst_firstname"),
        trimmed("cst_lastname").alias("cst_lastname"),
        code_label("cst_marital_status", MARITAL_STATUS).alias("cst_marital_status"),
        code_label("cst_gndr", GENDER).alias("cst_gndr"),
        "cst_create_date",
    )


def products(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "prd_id",
        key_prefix("prd_key", CATEGORY_ID_LENGTH).alias("cat_id"),
        key_suffix("prd_key", PRODUCT_KEY_START).alias("prd_key"),
        "prd_nm",
        or_default("prd_cost", 0).alias("prd_cost"),
        code_label("prd_line", PRODUCT_LINE).alias("prd_line"),
        to_day("prd_start_dt").alias("prd_start_dt"),
        to_day("prd_end_dt").alias("prd_end_dt"),
    )


def sales(bronze: DataFrame, on_invalid: str = "fail") -> DataFrame:
    days = {c: int_to_date(c, on_invalid) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")}
    return bronze.withColumns(days)


def locations(bronze: DataFrame) -> DataFrame:
    return bronze.select(trimmed("cid").alias("cid"), trimmed("cntry").alias("cntry"))


def demographics(bronze: DataFrame) -> DataFrame:
    return bronze.select(trimmed("cid").alias("cid"), "bdate", code_label("gen", GENDER).alias("gen"))


def categories(bronze: DataFrame) -> DataFrame:
    return bronze.select(*[trimmed(c).alias(c) for c in ("id", "cat", "subcat", "maintenance")])


JOBS = {
    "crm_cust_info": customers,
    "crm_prd_info": products,
    "crm_sales_details": sales,
    "erp_loc_a101": locations,
    "erp_cust_az12": demographics,
    "erp_px_cat_g1v2": categories,
}


def with_load_time(df: DataFrame) -> DataFrame:
    return df.withColumn("dwh_create_date", loaded_at())
