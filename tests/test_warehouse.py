import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from layerkit.operators.checks import strict
from layerkit.operators.contracts import ContractError
from layerkit.plans import gold, quality
from layerkit.plans.schemas import SOURCE_FILES
from layerkit.plans.warehouse import StepFailed, Warehouse
from layerkit.sources.tables import publish_view, write_table

FILES = {
    "crm_cust_info": """cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date
1,C1, Ann ,Old, s ,f,2024-01-01
1,C1, Ann ,New, M ,f,2024-02-01
2,C2,Bob,Dated,X,,2024-01-01
3,C3,Cem,Only,"",M,2024-01-01
4,C4,Dee,Only,,,2024-03-01
,C9,No,Key,S,F,2024-01-01
""",
    "crm_prd_info": """prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt
10,AC-HE-HL-1,Helmet,12,S ,2011-07-01,2007-12-28
11,AC-HE-HL-1,Helmet,,S ,2013-07-01,
12,CO-PE-PD-2,Pedal,30,m ,2012-07-01,
13,BI-RB-BK-3,Bike,900,,2012-07-01,2010-01-01
""",
    "crm_sales_details": """sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price
S1,HL-1,1,20110101,20110105,20110110,12,1,12
S2,PD-2,2,0,20110105,20110110,60,2,30
S3,BK-3,3,32154,20110105,20110110,900,1,900
S4,HL-1,77,20110101,20110105,20110110,0,1,0
S5,HL-1,4,20110107,20110105,,-12,1,-12
""",
    "erp_loc_a101": "CID,CNTRY\n C1 , France \nC2,Italy\nC3,\n",
    "erp_cust_az12": "CID,BDATE,GEN\nC1,1980-01-01,M\nC2,1970-01-01, m \nC3,,F\n",
    "erp_px_cat_g1v2": "ID,CAT,SUBCAT,MAINTENANCE\nAC_HE,Accessories,Helmets,Yes\n",
}


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    folder = tmp_path_factory.mktemp("source")
    for table, text in FILES.items():
        path = folder / SOURCE_FILES[table]
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
    return folder


@pytest.fixture(scope="module")
def built(spark, source, tmp_path_factory):
    house = Warehouse(spark, str(source), str(tmp_path_factory.mktemp("house")), strict(), contracts=quality.CONTRACTS)
    house.log = house.build("run1")
    return house


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_customers_keep_the_latest_row(built):
    got = rows(built.table("silver.crm_cust_info").drop("dwh_create_date"))
    day = dt.date(2024, 1, 1)
    assert got == [
        (1, "C1", "Ann", "New", "Married", "Female", dt.date(2024, 2, 1)),
        (2, "C2", "Bob", "Dated", "n/a", "n/a", day),
        (3, "C3", "Cem", "Only", "n/a", "Male", day),
        (4, "C4", "Dee", "Only", "n/a", "n/a", dt.date(2024, 3, 1)),
    ]
    assert built.table("silver.crm_cust_info").where("dwh_create_date is null").count() == 0


def test_products_split_keys(built):
    got = rows(built.table("silver.crm_prd_info").select("prd_id", "cat_id", "prd_key", "prd_cost", "prd_line"))
    assert got == [(10, "AC_HE", "HL-1", 12, "Other Sales"), (11, "AC_HE", "HL-1", 0, "Other Sales"),
                   (12, "CO_PE", "PD-2", 30, "Mountain"), (13, "BI_RB", "BK-3", 900, "n/a")]


def test_dimensions(built):
    customers = built.table("gold.dim_customers").orderBy("customer_key")
    got = [(r.customer_key, r.customer_id, r.country, r.gender) for r in customers.collect()]
    assert got == [(1, 1, "France", "Female"), (2, 2, "Italy", "Male"), (3, 3, None, "Male"), (4, 4, None, "n/a")]
    products = built.table("gold.dim_products").orderBy("product_key").collect()
    assert [(r.product_key, r.product_number, r.category) for r in products] == [(1, "PD-2", None), (2, "HL-1", "Accessories")]


def test_fact(built):
    got = rows(built.table("gold.fact_sales").select("order_number", "product_key", "customer_key", "order_date"))
    assert got == [("S1", 2, 1, dt.date(2011, 1, 1)), ("S2", 1, 2, None), ("S3", None, 3, None),
                   ("S4", 2, None, dt.date(2011, 1, 1)), ("S5", 2, 4, dt.date(2011, 1, 7))]


def test_repeated_erp_rows_fan_out(spark, built):
    silver = {t: built.table(f"silver.{t}") for t in ("crm_cust_info", "erp_cust_az12", "erp_loc_a101")}
    extra = spark.createDataFrame([("C2", "Spain", None)], silver["erp_loc_a101"].schema)
    dims = gold.dim_customers(silver["crm_cust_info"], silver["erp_cust_az12"], silver["erp_loc_a101"].union(extra))
    got = [(r.customer_key, r.customer_id, r.country) for r in dims.orderBy("customer_key").collect()]
    assert got == [(1, 1, "France"), (2, 2, "Italy"), (3, 2, "Spain"), (4, 3, None), (5, 4, None)]


def test_checks(spark, built):
    got = {r.check_name: (r.total_records, r.issues_found, r.status)
           for layer in ("silver", "gold")
           for r in spark.read.json(built.artifacts(f"{layer}_quality_summary/checks")).collect()}
    assert got == {
        "customer_duplicates": (4, 0, "PASS"), "invalid_marital": (4, 0, "PASS"), "invalid_gender": (4, 0, "PASS"),
        "null_cst_id": (4, 0, "PASS"), "product_duplicates": (4, 1, "FAIL"), "invalid_prd_line": (4, 0, "PASS"),
        "invalid_order_dates": (5, 2, "FAIL"), "customer_key_duplicates": (4, 0, "PASS"),
        "product_key_duplicates": (2, 0, "PASS"), "orphaned_sales": (5, 2, "FAIL"),
    }
    lost = spark.read.option("header", True).csv(built.artifacts("issues", "gold_orphaned_sales.csv"))
    assert rows(lost.select("order_number")) == [("S3",), ("S4",)]
    none = spark.read.option("header", True).csv(built.artifacts("issues", "silver_null_cst_id.csv"))
    assert none.columns[0] == "cst_id" and none.count() == 0


def test_run_log_and_profile(spark, built):
    assert [r.state for r in built.log.orderBy("pos", "at").collect()] == ["running", "success"] * 13
    profile = spark.read.parquet(built.artifacts("silver_profile"))
    assert profile.select("table_name").distinct().count() == 3


def test_expectations(built):
    got = built.expectations("silver")
    assert got.count() == 20
    failed = {(r.suite, r.expectation_pos) for r in got.where("not success").collect()}
    assert ("silver_crm_sales_details_suite", 1) in failed and ("silver_crm_cust_info_suite", 1) not in failed


def test_repeating_a_load_changes_nothing(built):
    before = rows(built.table("gold.dim_customers"))
    built.load_bronze()
    built.load_silver()
    built.load_gold()
    assert rows(built.table("gold.dim_customers")) == before


def test_published_contracts_fail_where_they_ask_too_much(built):
    from layerkit.operators.contracts import check_contract, outcome

    def status(table, contracts):
        return outcome(check_contract(built.table(table), contracts[table])).first().status

    assert status("bronze.crm_cust_info", quality.CONTRACTS) == "PASS"
    assert status("bronze.crm_cust_info", quality.PUBLISHED_CONTRACTS) == "FAIL"
    assert status("gold.dim_customers", quality.PUBLISHED_CONTRACTS) == "FAIL"


def test_published_contract_of_the_raw_table_is_the_default(spark, source, tmp_path):
    with pytest.raises(StepFailed, match="contract_bronze"):
        Warehouse(spark, str(source), str(tmp_path / "house")).build("run1")


def test_broken_contract_stops_the_run(spark, source, tmp_path):
    broken = tmp_path / "source"
    for table, text in FILES.items():
        path = broken / SOURCE_FILES[table]
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text.replace("2024-03-01", "") if table == "crm_cust_info" else text)
    with pytest.raises(StepFailed) as failure:
        Warehouse(spark, str(broken), str(tmp_path / "house"), contracts=quality.CONTRACTS).build("run2")
    assert isinstance(failure.value.__cause__, ContractError)
    alert = failure.value.alert.first()
    assert (alert.step, alert.status) == ("contract_silver", "FAIL") and "contract_silver failed" in alert.message
    assert spark.read.json(f"{tmp_path}/house/artifacts/run_alerts/run2").count() == 1
    last = failure.value.log.orderBy(F.desc("pos"), F.desc("at")).first()
    assert (last.step, last.state) == ("contract_silver", "failed")


def test_bad_date_fails_or_becomes_null(spark, source, tmp_path):
    bad = tmp_path / "source" / SOURCE_FILES["crm_sales_details"]
    bad.parent.mkdir(parents=True)
    bad.write_text(FILES["crm_sales_details"].replace("20110107", "20231301"))
    house = Warehouse(spark, str(tmp_path / "source"), str(tmp_path / "house"))
    house.define()
    house.load_bronze(["crm_sales_details"])
    with pytest.raises(Exception, match="20231301"):
        house.load_silver(["crm_sales_details"])
    house.on_invalid_date = "null"
    house.load_silver(["crm_sales_details"])
    assert house.table("silver.crm_sales_details").where("sls_order_dt is null").count() == 3


def test_views(spark, tmp_path):
    view = publish_view(spark.range(3), "gold.some_view")
    assert view.count() == 3 and spark.table("gold_some_view").count() == 3


@pytest.mark.skipif("RETAIL_SOURCE" not in os.environ, reason="needs the published product files")
def test_published_products(spark, tmp_path):
    house = Warehouse(spark, os.environ["RETAIL_SOURCE"], str(tmp_path))
    house.define()
    for layer in (house.load_bronze, house.load_silver):
        layer(["crm_prd_info", "erp_px_cat_g1v2"])
    from layerkit.operators.checks import run_checks
    from layerkit.plans.gold import dim_products

    dims = dim_products(house.table("silver.crm_prd_info"), house.table("silver.erp_px_cat_g1v2"))
    write_table(dims, str(tmp_path), "gold.dim_products")
    wanted = [c for c in (*quality.SILVER_CHECKS, *quality.GOLD_CHECKS) if "prd" in c.name or "product" in c.name]
    got = {r.check_name: (r.total_records, r.issues_found, r.clean_percentage, r.status)
           for r in run_checks(spark, wanted, policy=strict()).collect()}
    assert got == {"product_duplicates": (397, 77, 80.6, "FAIL"), "invalid_prd_line": (397, 0, 100.0, "PASS"),
                   "product_key_duplicates": (197, 0, 100.0, "PASS")}
    lost = house.table("gold.dim_products").where("category is null")
    assert lost.count() == 7 and lost.select("category_id").distinct().collect()[0][0] == "CO_PE"
