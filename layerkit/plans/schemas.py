"""Table layouts of the retail warehouse (names and types are fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "text": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}


def _layout(text: str) -> T.StructType:
    pairs = (item.split() for item in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BRONZE = {
    "crm_cust_info": _layout(
        "cst_id int, cst_key text, cst_firstname text, cst_lastname text, "
        "cst_marital_status text, cst_gndr text, cst_create_date date"
    ),
    "crm_prd_info": _layout(
        "prd_id int, prd_key text, prd_nm text, prd_cost int, prd_line text, "
        "prd_start_dt timestamp, prd_end_dt timestamp"
    ),
    "crm_sales_details": _layout(
        "sls_ord_num text, sls_prd_key text, sls_cust_id int, sls_order_dt int, sls_ship_dt int, "
        "sls_due_dt int, sls_sales int, sls_quantity int, sls_price int"
    ),
    "erp_loc_a101": _layout("cid text, cntry text"),
    "erp_cust_az12": _layout("cid text, bdate date, gen text"),
    "erp_px_cat_g1v2": _layout("id text, cat text, subcat text, maintenance text"),
}

# source file of each bronze table, below the folder of the source files
SOURCE_FILES = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_loc_a101": "source_erp/LOC_A101.csv",
    "erp_cust_az12": "source_erp/CUST_AZ12.csv",
    "erp_px_cat_g1v2": "source_erp/PX_CAT_G1V2.csv",
}

_LOADED = ", dwh_create_date timestamp"

SILVER = {
    "crm_cust_info": _layout(
        "cst_id int, cst_key text, cst_firstname text, cst_lastname text, "
        "cst_marital_status text, cst_gndr text, cst_create_date date" + _LOADED
    ),
    "crm_prd_info": _layout(
        "prd_id int, cat_id text, prd_key text, prd_nm text, prd_cost int, prd_line text, "
        "prd_start_dt date, prd_end_dt date" + _LOADED
    ),
    "crm_sales_details": _layout(
        "sls_ord_num text, sls_prd_key text, sls_cust_id int, sls_order_dt date, sls_ship_dt date, "
        "sls_due_dt date, sls_sales int, sls_quantity int, sls_price int" + _LOADED
    ),
    "erp_loc_a101": _layout("cid text, cntry text" + _LOADED),
    "erp_cust_az12": _layout("cid text, bdate date, gen text" + _LOADED),
    "erp_px_cat_g1v2": _layout("id text, cat text, subcat text, maintenance text" + _LOADED),
}

GOLD = {
    "dim_customers": _layout(
        "customer_key bigint, customer_id int, customer_number text, first_name text, last_name text, "
        "country text, marital_status text, gender text, birthdate date, create_date date"
    ),
    "dim_products": _layout(
        "product_key bigint, product_id int, product_number text, product_name text, "
        "category_id text, category text, subcategory text, maintenance text, cost int, "
        "product_line text, start_date date"
    ),
    "fact_sales": _layout(
        "order_number text, product_key bigint, customer_key bigint, order_date date, "
        "shipping_date date, due_date date, sales_amount int, quantity int, price int"
    ),
}
