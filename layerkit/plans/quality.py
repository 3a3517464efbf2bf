"""Checks, expectation suites and contracts of the retail warehouse."""

from __future__ import annotations

from dataclasses import replace

from layerkit.operators.checks import (
    DuplicateCheck,
    QueryCheck,
    missing,
    missing_beside,
    outside_domain,
)
from layerkit.operators.contracts import Contract, Field
from layerkit.operators.expectations import (
    Suite,
    between,
    in_set,
    not_null,
    of_type,
    row_count_between,
    unique,
)
from layerkit.plans.gold import orphaned_facts

# allowed labels (fixed values)
MARITAL = ("Single", "Married", "n/a")
GENDERS = ("Female", "Male", "n/a")
LINES = ("Mountain", "Road", "Other Sales", "Touring", "n/a")

# check names, descriptions, severities and reported columns are fixed values
SILVER_CHECKS = (
    DuplicateCheck(
        name="customer_duplicates", table="silver.crm_cust_info", keys=["cst_id"], severity="high",
        description="Check for duplicate customer IDs",
    ),
    outside_domain(
        "cst_marital_status", MARITAL, name="invalid_marital", table="silver.crm_cust_info",
        show=["cst_id", "cst_marital_status"], severity="medium",
        description="Check for invalid marital status values",
    ),
    outside_domain(
        "cst_gndr", GENDERS, name="invalid_gender", table="silver.crm_cust_info",
        show=["cst_id", "cst_gndr"], severity="medium",
        description="Check for invalid gender values",
    ),
    missing(
        "cst_id", name="null_cst_id", table="silver.crm_cust_info", severity="critical",
        description="Check for null customer IDs",
    ),
    DuplicateCheck(
        name="product_duplicates", table="silver.crm_prd_info", keys=["prd_key"], severity="high",
        description="Check for duplicate product keys",
    ),
    outside_domain(
        "prd_line", LINES, name="invalid_prd_line", table="silver.crm_prd_info",
        show=["prd_id", "prd_line"], severity="medium",
        description="Check for invalid product line values",
    ),
    missing_beside(
        "sls_order_dt", "sls_ord_num", name="invalid_order_dates", table="silver.crm_sales_details",
        show=["sls_ord_num", "sls_order_dt"], severity="medium",
        description="Check for invalid order dates",
    ),
)

GOLD_CHECKS = (
    DuplicateCheck(
        name="customer_key_duplicates", table="gold.dim_customers", keys=["customer_key"],
        count_as="duplicate_count", severity="critical",
        description="Check for duplicate customer keys in dimension",
    ),
    DuplicateCheck(
        name="product_key_duplicates", table="gold.dim_products", keys=["product_key"],
        count_as="duplicate_count", severity="critical",
        description="Check for duplicate product keys in dimension",
    ),
    QueryCheck(
        name="orphaned_sales", table="gold.fact_sales", severity="high",
        description="Check for sales facts without matching dimensions",
        issues=lambda get: orphaned_facts(
            get("gold.fact_sales"), get("gold.dim_products"), get("gold.dim_customers")
        ),
    ),
)

CHECKS = {"silver": SILVER_CHECKS, "gold": GOLD_CHECKS}

# issue files by check (fixed values)
ISSUE_FILES = {
    "customer_duplicates": "silver_cust_duplicates.csv",
    "invalid_marital": "silver_invalid_marital.csv",
    "invalid_gender": "silver_invalid_gender.csv",
    "null_cst_id": "silver_null_cst_id.csv",
    "product_duplicates": "silver_prd_duplicates.csv",
    "invalid_prd_line": "silver_invalid_prd_line.csv",
    "invalid_order_dates": "silver_invalid_order_dates.csv",
    "customer_key_duplicates": "gold_cust_key_duplicates.csv",
    "product_key_duplicates": "gold_prod_key_duplicates.csv",
    "orphaned_sales": "gold_orphaned_sales.csv",
}

# suites (columns and bounds are fixed values; some name columns the tables lack, which shows
# as a failed expectation)
SUITES = {
    "silver.crm_cust_info": Suite(
        "silver_crm_cust_info_suite",
        [
            row_count_between(1000, 100000),
            not_null("cst_id"),
            unique("cst_id"),
            in_set("cst_marital_status", MARITAL),
            in_set("cst_gndr", GENDERS),
            of_type("cst_id", "INTEGER"),
        ],
    ),
    "silver.crm_prd_info": Suite(
        "silver_crm_prd_info_suite",
        [
            row_count_between(100, 10000),
            not_null("prd_id"),
            unique("prd_id"),
            of_type("prd_id", "INTEGER"),
            of_type("prd_cost", "FLOAT"),
            between("prd_cost", 0, 10000),
        ],
    ),
    "silver.crm_sales_details": Suite(
        "silver_crm_sales_details_suite",
        [
            row_count_between(10000, 1000000),
            not_null("sls_id"),
            unique("sls_id"),
            not_null("sls_cst_id"),
            not_null("sls_prd_id"),
            of_type("sls_quantity", "INTEGER"),
            between("sls_quantity", 1, 1000),
            of_type("sls_sales_date", "DATE"),
        ],
    ),
    "gold.dim_customers": Suite(
        "gold_dim_customers_suite",
        [
            row_count_between(1000, 100000),
            not_null("customer_key"),
            unique("customer_key"),
            not_null("customer_id"),
            unique("customer_id"),
            in_set("marital_status", MARITAL),
            in_set("gender", GENDERS),
            of_type("customer_key", "INTEGER"),
        ],
    ),
    "gold.dim_products": Suite(
        "gold_dim_products_suite",
        [
            row_count_between(100, 10000),
            not_null("product_key"),
            unique("product_key"),
            not_null("product_id"),
            unique("product_id"),
            of_type("product_key", "INTEGER"),
            of_type("cost", "FLOAT"),
            between("cost", 0, 10000),
        ],
    ),
    "gold.fact_sales": Suite(
        "gold_fact_sales_suite",
        [
            row_count_between(10000, 1000000),
            not_null("order_number"),
            not_null("product_key"),
            not_null("customer_key"),
            of_type("quantity", "INTEGER"),
            between("quantity", 1, 1000),
            of_type("sales_amount", "FLOAT"),
            between("sales_amount", 0, 100000),
            of_type("order_date", "DATE"),
        ],
    ),
}


def layer_suites(layer: str, growth: int = 1) -> dict[str, Suite]:
    """The layer's suites, with the published ceilings of row counts times `growth`."""

    def grown(e):
        most = e.kwargs.get("max_value") if e.column is None else None
        return e if most is None or growth == 1 else replace(e, kwargs={**e.kwargs, "max_value": most * growth})

    wanted = {t: s for t, s in SUITES.items() if t.startswith(f"{layer}.")}
    return {t: replace(s, expectations=[grown(e) for e in s.expectations]) for t, s in wanted.items()}


_INT = ("int", "bigint")
_DAY = ("date", "timestamp", "timestamp_ntz")
_TEXT = ("string",)

# Labels and unique ids hold only after cleansing: these ask the raw table for types alone, and
# the customer dimension for the integer key it has.
CONTRACTS = {
    "bronze.crm_cust_info": Contract(
        "bronze_crm_cust",
        {
            "cst_id": Field(_INT),
            "cst_key": Field(_TEXT),
            "cst_firstname": Field(_TEXT),
            "cst_lastname": Field(_TEXT),
            "cst_marital_status": Field(_TEXT),
            "cst_gndr": Field(_TEXT),
            "cst_create_date": Field(_DAY),
        },
    ),
    "silver.crm_cust_info": Contract(
        "silver_crm_cust",
        {
            "cst_id": Field(_INT, nullable=False, unique=True),
            "cst_key": Field(_TEXT, nullable=False, unique=True),
            "cst_firstname": Field(_TEXT, nullable=False),
            "cst_lastname": Field(_TEXT, nullable=False),
            "cst_marital_status": Field(_TEXT, isin=MARITAL),
            "cst_gndr": Field(_TEXT, isin=GENDERS),
            "cst_create_date": Field(_DAY, nullable=False),
        },
    ),
    "gold.dim_customers": Contract(
        "gold_dim_customers",
        {
            "customer_key": Field(_INT, nullable=False, unique=True),
            "customer_id": Field(_INT, nullable=False, unique=True),
            "first_name": Field(_TEXT, nullable=False),
            "last_name": Field(_TEXT, nullable=False),
            "marital_status": Field(_TEXT, isin=MARITAL),
            "gender": Field(_TEXT, isin=GENDERS),
            "create_date": Field(_DAY, nullable=False),
        },
    ),
}

# The contracts exactly as published, raw labels and a text key included.
PUBLISHED_CONTRACTS = {
    **CONTRACTS,
    "bronze.crm_cust_info": Contract("bronze_crm_cust", {
        **CONTRACTS["bronze.crm_cust_info"].fields,
        "cst_id": Field(_INT, nullable=False, unique=True),
        "cst_marital_status": Field(_TEXT, isin=MARITAL),
        "cst_gndr": Field(_TEXT, isin=GENDERS),
    }),
    "gold.dim_customers": Contract("gold_dim_customers", {
        **CONTRACTS["gold.dim_customers"].fields,
        "customer_key": Field(_TEXT, nullable=False, unique=True),
    }),
}

# tables profiled per layer
PROFILED = {
    "silver": ("silver.crm_cust_info", "silver.crm_prd_info", "silver.crm_sales_details"),
    "gold": ("gold.dim_customers", "gold.dim_products", "gold.fact_sales"),
}
