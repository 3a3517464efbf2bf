"""The retail warehouse's own jobs, fed with raw tables shaped from the given ones."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import lru_cache

from pyspark.sql import functions as F

from layerkit.operators.checks import check_results, tiered
from layerkit.operators.contracts import Contract, Field, check_contract
from layerkit.operators.joins import left_join
from layerkit.plans import gold, quality, silver
from layerkit.plans.queries.data import table
from layerkit.plans.queries.quality import _TIERED_SQL
from layerkit.plans.quality import PUBLISHED_CONTRACTS
from layerkit.plans.schemas import SILVER, SOURCE_FILES
from layerkit.plans.warehouse import StepFailed, Warehouse
from layerkit.session import new_path
from layerkit.sources.csv import write_csv
from layerkit.sources.tables import create_layers
from layerkit.sources.versions import AuditFailed, keeps, publish


def _codes(column, codes):
    chain = None
    for value, code in codes.items():
        chain = (F if chain is None else chain).when(F.col(column) == value, code)
    return chain


def _codes_sql(column, codes):
    return f"CASE {column} " + " ".join(f"WHEN '{v}' THEN '{c}'" for v, c in codes.items()) + " END"


MARITAL = {"F": " s ", "O": "M", "P": "?"}
GENDER = {"1-URGENT": "f", "2-HIGH": " M", "3-MEDIUM": ""}
ERP_GENDER = {"BUILDING": "F", "MACHINERY": " m", "FURNITURE": "x"}
LINE = {"Brand#1": "m ", "Brand#2": "R ", "Brand#3": "s", "Brand#4": " T", "Brand#5": "Z"}


def raw_customers(spark, sf):
    """Every order is one version of its customer's record; low-priority ones carry no date."""
    orders = table(spark, sf, "orders")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return left_join(orders, customers, "o_custkey", "c_custkey").select(
        F.col("o_custkey").cast("int").alias("cst_id"),
        F.col("c_name").alias("cst_key"),
        F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("cst_firstname"),
        F.concat("o_orderpriority", F.lit("  ")).alias("cst_lastname"),
        _codes("o_orderstatus", MARITAL).alias("cst_marital_status"),
        _codes("o_orderpriority", GENDER).alias("cst_gndr"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate").cast("date")).alias("cst_create_date"),
    )


RAW_CUSTOMERS_SQL = f"""
  SELECT CAST(o_custkey AS INTEGER) AS cst_id, c_name AS cst_key, '  ' || c_mktsegment || ' ' AS cst_firstname,
         o_orderpriority || '  ' AS cst_lastname, {_codes_sql('o_orderstatus', MARITAL)} AS cst_marital_status,
         {_codes_sql('o_orderpriority', GENDER)} AS cst_gndr,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS cst_create_date
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""


def raw_products(spark, sf):
    start = F.date_add(F.lit("1995-01-01").cast("date"), F.col("p_size")).cast("timestamp_ntz")
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("prd_id"),
        F.concat(
            F.substring("p_type", 1, 2), F.lit("-"), F.substring("p_type", 3, 2), F.lit("-"),
            F.col("p_partkey").cast("string"),
        ).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(F.col("p_brand") != "Brand#7", F.floor("p_retailprice").cast("int")).alias("prd_cost"),
        _codes("p_brand", LINE).alias("prd_line"),
        start.alias("prd_start_dt"),
        F.when(F.col("p_size") > 40, start).alias("prd_end_dt"),
    )


RAW_PRODUCTS_SQL = f"""
  SELECT CAST(p_partkey AS INTEGER) AS prd_id,
         substring(p_type, 1, 2) || '-' || substring(p_type, 3, 2) || '-' || p_partkey AS prd_key, p_name AS prd_nm,
         CASE WHEN p_brand <> 'Brand#7' THEN CAST(floor(p_retailprice) AS INTEGER) END AS prd_cost,
         {_codes_sql('p_brand', LINE)} AS prd_line,
         CAST(DATE '1995-01-01' + p_size AS TIMESTAMP) AS prd_start_dt,
         CASE WHEN p_size > 40 THEN CAST(DATE '1995-01-01' + p_size AS TIMESTAMP) END AS prd_end_dt
  FROM part"""


def raw_sales(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    ordered = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "0").when(
        F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyyMM")
    ).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    shipped = F.date_format("l_shipdate", "yyyyMMdd").cast("int")
    return left_join(table(spark, sf, "lineitem"), orders, "l_orderkey", "o_orderkey").select(
        F.concat(F.lit("SO"), F.col("l_orderkey").cast("string")).alias("sls_ord_num"),
        F.col("l_partkey").cast("string").alias("sls_prd_key"),
        F.col("o_custkey").cast("int").alias("sls_cust_id"),
        ordered.cast("int").alias("sls_order_dt"),
        shipped.alias("sls_ship_dt"),
        F.when(F.col("l_linestatus") == "O", shipped).alias("sls_due_dt"),
        F.floor("l_extendedprice").cast("int").alias("sls_sales"),
        F.col("l_quantity").cast("int").alias("sls_quantity"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("int").alias("sls_price"),
    )


RAW_SALES_SQL = """
  SELECT 'SO' || l_orderkey AS sls_ord_num, CAST(l_partkey AS VARCHAR) AS sls_prd_key,
         CAST(o_custkey AS INTEGER) AS sls_cust_id,
         CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '0'
                   WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y%m')
                   ELSE strftime(o_orderdate, '%Y%m%d') END AS INTEGER) AS sls_order_dt,
         CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS sls_ship_dt,
         CASE WHEN l_linestatus = 'O' THEN CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) END AS sls_due_dt,
         CAST(floor(l_extendedprice) AS INTEGER) AS sls_sales, CAST(l_quantity AS INTEGER) AS sls_quantity,
         CAST(floor(l_extendedprice / l_quantity) AS INTEGER) AS sls_price
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""


def raw_locations(spark, sf):
    customers = table(spark, sf, "customer").select("c_name", "c_nationkey")
    joined = left_join(customers, table(spark, sf, "nation"), "c_nationkey", "n_nationkey")
    return joined.select(F.concat(F.lit(" "), "c_name").alias("cid"), F.concat("n_name", F.lit(" ")).alias("cntry"))


def raw_demographics(spark, sf):
    born = F.date_add(F.lit("1960-01-01").cast("date"), F.col("c_nationkey"))
    return table(spark, sf, "customer").select(
        F.concat("c_name", F.lit(" ")).alias("cid"), born.alias("bdate"), _codes("c_mktsegment", ERP_GENDER).alias("gen")
    )


def raw_categories(spark, sf):
    """A category per product type but one."""
    kinds = table(spark, sf, "part").where("p_type <> 'PROMO'").select("p_type").distinct()
    return kinds.select(
        F.concat(F.substring("p_type", 1, 2), F.lit("_"), F.substring("p_type", 3, 2), F.lit(" ")).alias("id"),
        F.concat(F.lit(" "), "p_type").alias("cat"),
        F.lower("p_type").alias("subcat"),
        F.lit("Yes ").alias("maintenance"),
    )


def tables(spark, sf):
    """Tables of all layers by name, each planned once."""
    plans = {
        "silver.crm_cust_info": lambda: silver.customers(raw_customers(spark, sf)),
        "silver.crm_prd_info": lambda: silver.products(raw_products(spark, sf)),
        "silver.crm_sales_details": lambda: silver.sales(raw_sales(spark, sf)),
        "silver.erp_loc_a101": lambda: silver.locations(raw_locations(spark, sf)),
        "silver.erp_cust_az12": lambda: silver.demographics(raw_demographics(spark, sf)),
        "silver.erp_px_cat_g1v2": lambda: silver.categories(raw_categories(spark, sf)),
        "gold.dim_customers": lambda: gold.dim_customers(
            get("silver.crm_cust_info"), get("silver.erp_cust_az12"), get("silver.erp_loc_a101")
        ),
        "gold.dim_products": lambda: gold.dim_products(get("silver.crm_prd_info"), get("silver.erp_px_cat_g1v2")),
        "gold.fact_sales": lambda: gold.fact_sales(
            get("silver.crm_sales_details"), get("gold.dim_products"), get("gold.dim_customers")
        ),
    }

    @lru_cache(maxsize=None)
    def get(name):
        return plans[name]()

    return get


def _table(name):
    return lambda spark, sf: tables(spark, sf)(name)


def _checks(layer):
    def query(spark, sf):
        results = check_results(spark, quality.CHECKS[layer], tables(spark, sf), tiered())
        return results.select("check_name", "total_records", "issues_found", "clean_percentage", "status")

    return query


def contract_published(spark, sf):
    """The raw customers against the published contract: labels and ids are not cleansed yet."""
    name = "bronze.crm_cust_info"
    rules = check_contract(raw_customers(spark, sf), PUBLISHED_CONTRACTS[name])
    return rules.where("rule <> 'type'").select("column_name", "rule", "failures", "status")


def _house(spark, sf, **options):
    """A warehouse over source files of the raw tables."""
    path = new_path(spark, "warehouse")
    raw = {
        "crm_cust_info": raw_customers, "crm_prd_info": raw_products, "crm_sales_details": raw_sales,
        "erp_loc_a101": raw_locations, "erp_cust_az12": raw_demographics, "erp_px_cat_g1v2": raw_categories,
    }
    for name, make in raw.items():
        write_csv(make(spark, sf), f"{path}/source/{SOURCE_FILES[name]}")
    return Warehouse(spark, f"{path}/source", f"{path}/house", **options)


def stopped_run(spark, sf):
    """A run over raw tables whose labels are not cleansed, so the published raw contract stops it."""
    try:
        _house(spark, sf).build("run")
    except StepFailed as stopped:
        return stopped
    raise RuntimeError("the raw contract was kept")


def pipeline_full_run(spark, sf):
    """The log of a run through all steps, under contracts that the raw tables keep: some customers have
    no date."""
    contracts = dict(quality.CONTRACTS)
    for name, day in (("silver.crm_cust_info", "cst_create_date"), ("gold.dim_customers", "create_date")):
        kept = contracts[name]
        fields = dict(kept.fields) | {day: replace(kept.fields[day], nullable=True)}
        contracts[name] = Contract(kept.name, fields)
    log = _house(spark, sf, contracts=contracts, on_invalid_date="null").build("run")
    return log.select("pos", "step", "state")


PUBLISHED_SALES = Contract("silver.crm_sales_details", {
    "sls_ord_num": Field(("string",), nullable=False), "dwh_create_date": Field(("timestamp_ntz",), nullable=False),
})


def silver_publish(spark, sf):
    """The cleansed sales published; a second version without order numbers breaks the contract, so the
    first one is still read, with its time of loading."""
    root, table_name = new_path(spark, "published"), f"silver.sales_{uuid.uuid4().hex}"
    create_layers(spark, ["silver"])
    columns = SILVER["crm_sales_details"].fieldNames()
    first = silver.with_load_time(silver.sales(raw_sales(spark, sf), "null")).select(*columns)
    publish(first, root, table_name, [keeps(PUBLISHED_SALES)])
    try:
        publish(first.withColumn("sls_ord_num", F.lit(None).cast("string")), root, table_name, [keeps(PUBLISHED_SALES)])
    except AuditFailed as failed:
        loaded = F.col("dwh_create_date").isNotNull().alias("loaded")
        findings = F.lit(len(failed.findings)).alias("findings")
        return spark.table(table_name).select("sls_ord_num", "sls_prd_key", "sls_order_dt", "sls_sales", loaded, findings)
    raise RuntimeError("the broken version was published")


QUERIES = {
    "pipeline_run_log": lambda spark, sf: stopped_run(spark, sf).log.select("pos", "step", "state"),
    "ops_step_alert": lambda spark, sf: stopped_run(spark, sf).alert.select("step", "status"),
    "pipeline_full_run": pipeline_full_run,
    "silver_publish": silver_publish,
    "retail_silver_customers": _table("silver.crm_cust_info"),
    "retail_silver_products": _table("silver.crm_prd_info"),
    "retail_silver_sales": _table("silver.crm_sales_details"),
    "retail_dim_customers": _table("gold.dim_customers"),
    "retail_dim_products": _table("gold.dim_products"),
    "retail_fact_sales": _table("gold.fact_sales"),
    "contract_published": contract_published,
    "retail_silver_checks": _checks("silver"),
    "retail_gold_checks": _checks("gold"),
}

# --- SQL ----------------------------------------------------------------------------------

CUSTOMERS_SQL = f"""
  SELECT cst_id, cst_key, trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname,
         CASE upper(trim(cst_marital_status)) WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married' ELSE 'n/a' END AS cst_marital_status,
         CASE upper(trim(cst_gndr)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE 'n/a' END AS cst_gndr,
         cst_create_date
  FROM (SELECT *, row_number() OVER (
          PARTITION BY cst_id
          ORDER BY cst_create_date DESC NULLS FIRST, cst_key NULLS LAST, cst_firstname NULLS LAST,
                   cst_lastname NULLS LAST, cst_marital_status NULLS LAST, cst_gndr NULLS LAST) AS place
        FROM ({RAW_CUSTOMERS_SQL}) r WHERE cst_id IS NOT NULL) t
  WHERE place = 1"""

PRODUCTS_SQL = f"""
  SELECT prd_id, replace(substring(prd_key, 1, 5), '-', '_') AS cat_id, substring(prd_key, 7, length(prd_key)) AS prd_key,
         prd_nm, coalesce(prd_cost, 0) AS prd_cost,
         CASE upper(trim(prd_line)) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road' WHEN 'S' THEN 'Other Sales'
              WHEN 'T' THEN 'Touring' ELSE 'n/a' END AS prd_line,
         CAST(prd_start_dt AS DATE) AS prd_start_dt, CAST(prd_end_dt AS DATE) AS prd_end_dt
  FROM ({RAW_PRODUCTS_SQL}) r"""


def _day_sql(c):
    return f"""CASE WHEN {c} = 0 OR length(CAST({c} AS VARCHAR)) <> 8 THEN NULL
        ELSE CAST(strptime(CAST({c} AS VARCHAR), '%Y%m%d') AS DATE) END AS {c}"""


SALES_SQL = f"""
  SELECT sls_ord_num, sls_prd_key, sls_cust_id, {_day_sql('sls_order_dt')}, {_day_sql('sls_ship_dt')},
         {_day_sql('sls_due_dt')}, sls_sales, sls_quantity, sls_price
  FROM ({RAW_SALES_SQL}) r"""

DIM_CUSTOMERS_SQL = f"""
  SELECT CAST(row_number() OVER (ORDER BY cst_id) AS BIGINT) AS customer_key, cst_id AS customer_id,
         cst_key AS customer_number, cst_firstname AS first_name, cst_lastname AS last_name, n_name AS country,
         cst_marital_status AS marital_status,
         CASE WHEN cst_gndr <> 'n/a' THEN cst_gndr
              WHEN c_mktsegment = 'BUILDING' THEN 'Female' WHEN c_mktsegment = 'MACHINERY' THEN 'Male' ELSE 'n/a' END AS gender,
         DATE '1960-01-01' + c_nationkey AS birthdate, cst_create_date AS create_date
  FROM ({CUSTOMERS_SQL}) c LEFT JOIN customer ON cst_key = c_name LEFT JOIN nation ON c_nationkey = n_nationkey"""

DIM_PRODUCTS_SQL = f"""
  SELECT CAST(row_number() OVER (ORDER BY prd_start_dt, prd_key) AS BIGINT) AS product_key, prd_id AS product_id,
         prd_key AS product_number, prd_nm AS product_name, cat_id AS category_id, cat AS category,
         lower(cat) AS subcategory, CASE WHEN cat IS NOT NULL THEN 'Yes' END AS maintenance,
         prd_cost AS cost, prd_line AS product_line, prd_start_dt AS start_date
  FROM ({PRODUCTS_SQL}) p
  LEFT JOIN (SELECT DISTINCT p_type AS cat FROM part WHERE p_type <> 'PROMO') k
    ON cat_id = substring(cat, 1, 2) || '_' || substring(cat, 3, 2)
  WHERE prd_end_dt IS NULL"""

FACT_SQL = f"""
  SELECT sls_ord_num AS order_number, product_key, customer_key, sls_order_dt AS order_date,
         sls_ship_dt AS shipping_date, sls_due_dt AS due_date, sls_sales AS sales_amount,
         sls_quantity AS quantity, sls_price AS price
  FROM ({SALES_SQL}) s
  LEFT JOIN ({DIM_PRODUCTS_SQL}) p ON sls_prd_key = product_number
  LEFT JOIN ({DIM_CUSTOMERS_SQL}) c ON sls_cust_id = customer_id"""

_COUNTS_SQL = {
    "customer_duplicates": (CUSTOMERS_SQL, "SELECT cst_id FROM t GROUP BY cst_id HAVING count(*) > 1"),
    "invalid_marital": (CUSTOMERS_SQL, "SELECT 1 FROM t WHERE cst_marital_status NOT IN ('Single', 'Married', 'n/a')"),
    "invalid_gender": (CUSTOMERS_SQL, "SELECT 1 FROM t WHERE cst_gndr NOT IN ('Female', 'Male', 'n/a')"),
    "null_cst_id": (CUSTOMERS_SQL, "SELECT 1 FROM t WHERE cst_id IS NULL"),
    "product_duplicates": (PRODUCTS_SQL, "SELECT prd_key FROM t GROUP BY prd_key HAVING count(*) > 1"),
    "invalid_prd_line": (PRODUCTS_SQL, "SELECT 1 FROM t WHERE prd_line NOT IN ('Mountain', 'Road', 'Other Sales', 'Touring', 'n/a')"),
    "invalid_order_dates": (SALES_SQL, "SELECT 1 FROM t WHERE sls_order_dt IS NULL AND sls_ord_num IS NOT NULL"),
    "customer_key_duplicates": (DIM_CUSTOMERS_SQL, "SELECT customer_key FROM t GROUP BY customer_key HAVING count(*) > 1"),
    "product_key_duplicates": (DIM_PRODUCTS_SQL, "SELECT product_key FROM t GROUP BY product_key HAVING count(*) > 1"),
    "orphaned_sales": (FACT_SQL, "SELECT 1 FROM t WHERE customer_key IS NULL OR product_key IS NULL"),
}


def _checks_sql(layer):
    counts = " UNION ALL ".join(
        f"""SELECT '{c.name}' AS check_name, '{c.severity}' AS severity,
            (SELECT count(*) FROM ({_COUNTS_SQL[c.name][0]}) t) AS total_records,
            (WITH t AS ({_COUNTS_SQL[c.name][0]}) SELECT count(*) FROM ({_COUNTS_SQL[c.name][1]}) i) AS issues_found"""
        for c in quality.CHECKS[layer]
    )
    return f"""SELECT check_name, total_records, issues_found,
          CAST(printf('%.2f', clean_pct) AS DOUBLE) AS clean_percentage, {_TIERED_SQL} AS status
        FROM (SELECT *, (total_records - issues_found) / total_records * 100 AS clean_pct FROM ({counts}) c) m"""


_PUBLISHED_SQL = f"""
  SELECT column_name, rule, failures, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
    SELECT 'cst_id' AS column_name, 'not_null' AS rule, count(*) - count(cst_id) AS failures FROM ({RAW_CUSTOMERS_SQL}) r
    UNION ALL SELECT 'cst_id', 'unique', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
      SELECT count(*) AS n FROM ({RAW_CUSTOMERS_SQL}) r WHERE cst_id IS NOT NULL GROUP BY cst_id HAVING count(*) > 1) g
    UNION ALL SELECT 'cst_marital_status', 'isin', count(CASE WHEN cst_marital_status NOT IN ('Single', 'Married', 'n/a') THEN 1 END)
      FROM ({RAW_CUSTOMERS_SQL}) r
    UNION ALL SELECT 'cst_gndr', 'isin', count(CASE WHEN cst_gndr NOT IN ('Female', 'Male', 'n/a') THEN 1 END)
      FROM ({RAW_CUSTOMERS_SQL}) r) f"""

SQL = {
    "contract_published": _PUBLISHED_SQL,
    "pipeline_run_log": f"""
        SELECT CAST(pos AS INTEGER) AS pos, step, state
        FROM (VALUES (0, 'define'), (1, 'load_bronze'), (2, 'contract_bronze')) s(pos, step),
             (VALUES ('running'), ('success'), ('failed')) t(state)
        WHERE state = 'running'
           OR (state = 'failed') = (pos = 2 AND EXISTS (SELECT 1 FROM ({_PUBLISHED_SQL}) p WHERE status = 'FAIL'))""",
    "ops_step_alert": f"""
        SELECT DISTINCT 'contract_bronze' AS step, status FROM ({_PUBLISHED_SQL}) p WHERE status = 'FAIL'""",
    "pipeline_full_run": """
        SELECT CAST(pos AS INTEGER) AS pos, step, state
        FROM (VALUES (0, 'define'), (1, 'load_bronze'), (2, 'contract_bronze'), (3, 'load_silver'), (4, 'contract_silver'),
                     (5, 'expectations_silver'), (6, 'checks_silver'), (7, 'profile_silver'), (8, 'load_gold'),
                     (9, 'contract_gold'), (10, 'expectations_gold'), (11, 'checks_gold'), (12, 'profile_gold')) s(pos, step),
             (VALUES ('running'), ('success')) t(state)""",
    "silver_publish": f"""
        SELECT sls_ord_num, sls_prd_key, sls_order_dt, sls_sales, true AS loaded, CAST(1 AS INTEGER) AS findings
        FROM ({SALES_SQL}) s""",
    "retail_silver_customers": CUSTOMERS_SQL,
    "retail_silver_products": PRODUCTS_SQL,
    "retail_silver_sales": SALES_SQL,
    "retail_dim_customers": DIM_CUSTOMERS_SQL,
    "retail_dim_products": DIM_PRODUCTS_SQL,
    "retail_fact_sales": FACT_SQL,
    "retail_silver_checks": _checks_sql("silver"),
    "retail_gold_checks": _checks_sql("gold"),
}
