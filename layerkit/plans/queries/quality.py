"""Issue rows, check results, status policies, summaries and reports."""

from __future__ import annotations

from dataclasses import replace
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.operators import checks as C
from layerkit.operators.joins import Measurement, left_anti_join, left_join
from layerkit.operators.report import report_lines, write_issues, write_report, write_summary
from layerkit.plans.queries import star
from layerkit.plans.queries.cleanse import SQL as CLEANSE_SQL
from layerkit.plans.queries.cleanse import silver_int_dates
from layerkit.plans.queries.data import RAW_PARTS_SQL, raw_parts, table
from layerkit.session import new_path, store
from layerkit.sources.catalogue import load_catalogue
from layerkit.sources.csv import count_csv_rows

EVENT_TYPES = ("view", "click", "purchase", "signup")
PLAIN_URL = "^https://[a-z0-9.-]+/[a-z]{2}/[0-9]+$"
AS_OF = "2001-01-01"
STANDARD_LOCATIONS = tuple(f"NATION_{i}" for i in range(20))


def labelled_documents(spark, sf):
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("labelled_id"), "quality", "toxic")
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return left_join(documents, labels, "doc_id", "labelled_id").drop("labelled_id")


def customer_locations(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return left_join(customers, table(spark, sf, "nation"), "c_nationkey", "n_nationkey").select("c_custkey", "n_name")


def orphans(fact, products, customers):
    product = products.select(F.col("product_key").alias("p_key"), "product_id")
    customer = customers.select(F.col("customer_key").alias("c_key"), "customer_id")
    keys = Measurement(fact, "product_key", "customer_key")
    keyed = fact.select("order_number", "line", "customer_key", "product_key")
    joined = left_join(keyed, product, "product_key", "p_key", hot_from=keys)
    joined = left_join(joined, customer, "customer_key", "c_key", hot_from=keys)
    return joined.where("customer_id IS NULL OR product_id IS NULL").drop("p_key", "c_key")


def unknown_products(spark, sf):
    """Line items of parts that are unknown or no longer current."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    known = raw_parts(spark, sf).where("end_date IS NULL").select("p_partkey")
    return left_anti_join(lines, known, "l_partkey", "p_partkey")


CHECKS = (
    C.DuplicateCheck(name="line_duplicates", table="lineitem", keys=["l_orderkey", "l_linenumber"],
                     count_as="duplicate_count", severity="high", description="Repeated order lines"),
    C.outside_domain("event_type", EVENT_TYPES, name="event_domain", table="events", severity="medium",
                     show=["event_id", "event_type"], description="Unknown event types"),
    C.missing("quality", name="unlabelled", table="labelled_documents", severity="critical",
              show=["doc_id"], description="Documents without a quality label"),
    C.missing_beside("order_date", "o_orderkey", name="invalid_order_dates", table="order_dates",
                     severity="medium", show=["o_orderkey", "order_date"], description="Orders without a valid date"),
    C.not_positive("c_acctbal", name="invalid_amounts", table="customer", severity="low",
                   show=["c_custkey", "c_acctbal"], description="Balances of zero or less"),
    C.later_than("o_orderdate", AS_OF, name="future_dates", table="orders", severity="low",
                 show=["o_orderkey", "o_orderdate"], description="Orders after the reporting date"),
    C.not_matching("url", PLAIN_URL, name="url_pattern", table="pages", severity="low",
                   show=["page_id", "url"], description="Addresses of an unusual form"),
    C.outside_domain("n_name", STANDARD_LOCATIONS, name="location_codes", table="customer_locations",
                     severity="high", description="Customers at non-standard locations"),
    C.out_of_order("o_orderdate", "l_shipdate", name="date_order", table="dated_lines", severity="medium",
                   description="Lines shipped before they were ordered"),
    C.missing("category", name="missing_category", table="dim_product", severity="high",
              show=["product_key", "product_id", "category_id"], description="Products without a category"),
    C.DuplicateCheck(name="customer_key_duplicates", table="dim_customer", keys=["customer_key"],
                     count_as="duplicate_count", severity="critical", description="Repeated customer keys"),
    C.QueryCheck(name="orphan_facts", table="fact", severity="high",
                 description="Facts without a product or customer",
                 issues=lambda get: orphans(get("fact"), get("dim_product"), get("dim_customer"))),
    C.QueryCheck(name="orphan_lines", table="lineitem", severity="medium",
                 description="Lines of unknown products", issues=lambda get: get("unknown_products")),
)
BY_NAME = {c.name: c for c in CHECKS}


def tables(spark, sf):
    """The tables the checks name, each planned once so that dimension keys are shared."""
    derived = {
        "labelled_documents": lambda: labelled_documents(spark, sf),
        "order_dates": lambda: silver_int_dates(spark, sf),
        "customer_locations": lambda: customer_locations(spark, sf),
        "sales": lambda: store(star.sales(spark, sf), "sales"),
        "dated_lines": lambda: get("sales").select("l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate"),
        "dim_product": lambda: star.gold_dim_product(spark, sf),
        "dim_customer": lambda: star.gold_dim_customer(spark, sf),
        "fact": lambda: store(star.fact(get("sales"), get("dim_product"), get("dim_customer")), "fact"),
        "unknown_products": lambda: unknown_products(spark, sf),
    }

    @lru_cache(maxsize=None)
    def get(name: str) -> DataFrame:
        return derived[name]() if name in derived else table(spark, sf, name)

    return get


def _issues(name):
    return lambda spark, sf: C.issue_rows(spark, BY_NAME[name], tables(spark, sf))


def results(spark, sf, policy, checks=CHECKS):
    return C.check_results(spark, checks, tables(spark, sf), policy)


def done(spark, sf, policy, checks=CHECKS):
    """Results computed once, for consumers that read them several times."""
    return C.run_checks(spark, checks, tables(spark, sf), policy)


_STATUS = ("check_name", "severity", "issues_found", "clean_percentage", "status")


def dq_check_metrics(spark, sf):
    return results(spark, sf, C.tiered()).drop("error")


def dq_merge_results(spark, sf):
    """All checks under the strict rule, then the first six under the tiered one; counted once."""
    first = done(spark, sf, C.strict())
    again = C.restated(first.where("check_pos < 6"), C.tiered())
    return C.merge_results(first, again).select("check_pos", "check_name", "issues_found", "status")


def dq_concurrent(spark, sf):
    """Both layers checked at the same time."""
    layers = {"silver": CHECKS[:9], "gold": CHECKS[9:]}
    return C.layer_summary(C.run_concurrently(spark, layers, tables(spark, sf), C.tiered()))


def dq_single_check(spark, sf):
    """One check looked up by layer and name and run alone."""
    layers = {"silver": CHECKS[:9], "gold": CHECKS[9:]}
    return C.run_check(spark, layers, "silver", "date_order", tables(spark, sf), C.flat()).drop("error")


def sink_issue_counts(spark, sf):
    """Issue rows written as CSV by the executors, then counted from the files."""
    folder = new_path(spark, "issues")
    wanted = [BY_NAME[n] for n in ("event_domain", "line_duplicates", "future_dates", "orphan_facts")]
    problems = write_issues(spark, wanted, folder, tables(spark, sf))
    if problems:
        raise RuntimeError(str(problems))
    check = F.element_at(F.split("path", "/"), -2)
    return count_csv_rows(spark, folder).groupBy(check.alias("check_name")).agg(F.sum("n").alias("issues_found"))


def sink_json_summary(spark, sf):
    path = new_path(spark, "summary")
    write_summary(done(spark, sf, C.tiered()), path)
    rows = spark.read.schema(C.RESULT_SCHEMA).json(f"{path}/checks")
    return rows.drop("error")


def sink_text_report(spark, sf):
    """The short report as written; equal lines are counted because a text file has no order."""
    path = new_path(spark, "report")
    write_report(done(spark, sf, C.strict(), CHECKS[:9]), "silver", path, detailed=False)
    lines = spark.read.text(path).groupBy(F.col("value").alias("line"))
    return lines.agg(F.count(F.lit(1)).alias("n"))


def dq_report_lines(spark, sf):
    return report_lines(done(spark, sf, C.tiered()), "silver")


ODD_TYPES = ("view", "cl\\ick", "o'clock")
ODD_PATTERN = r"^https://[^'\\]+$"


def escapes(spark, sf):
    """Values and patterns with quotes and backslashes, made from given columns."""
    events, pages = table(spark, sf, "events"), table(spark, sf, "pages")
    kind = F.when(F.col("event_type") == "click", F.lit(ODD_TYPES[1])).otherwise(F.col("event_type"))
    address = F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit("?q='"))).otherwise(F.col("url"))
    found = C.run_checks(spark, [
        C.outside_domain("kind", [*ODD_TYPES, None], name="odd_types", table="events"),
        C.not_matching("address", ODD_PATTERN, name="odd_addresses", table="pages"),
    ], {"events": events.select(kind.alias("kind")), "pages": pages.select(address.alias("address"))})
    return found.select("check_name", "total_records", "issues_found")


def error_rows(spark, sf):
    """Checks of a missing column, a missing table and one that fails at run time, beside a good one."""
    found = C.run_checks(spark, [
        C.missing("value", name="good", table="events"),
        C.missing("no_such_column", name="no_column", table="events"),
        C.missing("value", name="no_table", table="no_such_table"),
        C.RowCheck(name="fails", table="events", where="raise_error('broken') IS NULL"),
    ], {"events": table(spark, sf, "events")}, C.strict())
    failed = F.col("error").isNotNull().alias("failed")
    return found.select("check_name", "total_records", "issues_found", "status", failed)


OBSERVED = tuple(c for c in CHECKS if isinstance(c, C.RowCheck))


def dq_observed_metrics(spark, sf):
    """The row checks counted while their tables are written."""
    get, watched = tables(spark, sf), C.ObservedChecks(OBSERVED)
    path = new_path(spark, "observed")
    for name in dict.fromkeys(c.table for c in OBSERVED):
        watched.watch(get(name), name).write.parquet(f"{path}/{name}")
    return watched.results(spark, C.tiered()).drop("error")


SQL_CHECKS = (
    C.QueryCheck(name="idle_customers", table="silver.customer", severity="low", description="Customers without orders",
                 issues="""SELECT c.c_custkey FROM silver.customer c LEFT ANTI JOIN silver.orders o ON c.c_custkey = o.o_custkey -- silver.orders"""),
    C.QueryCheck(name="large_orders", table="silver.orders", severity="medium", description="Orders above 'silver.orders' size",
                 issues="""WITH big AS (SELECT o_orderkey, o_totalprice FROM silver.orders WHERE silver.orders.o_totalprice > 400000)
                           SELECT * FROM big WHERE 'silver.orders' IS NOT NULL"""),
    C.missing("c_name", name="nameless", table="silver.customer", severity="high", description="Customers without a name"),
)


NEAR_UNIQUE = replace(BY_NAME["line_duplicates"], near_unique=True)


def duplicates_by_hash(spark, sf):
    """Repeated order lines, of which only those whose key's hash repeats are shuffled."""
    return C.issue_rows(spark, NEAR_UNIQUE, tables(spark, sf))


def dq_layer_sql(spark, sf):
    """Checks written as SQL over tables named by layer."""
    given = {f"silver.{n}": table(spark, sf, n) for n in ("customer", "orders")}
    return C.run_checks(spark, SQL_CHECKS, given, C.flat()).drop("error")


def yaml_catalogue(spark, sf):
    """Checks and threshold from a YAML file, statements included."""
    catalogue = load_catalogue(str(Path(__file__).with_name("checks.yaml")))
    given = {n: table(spark, sf, n) for n in ("customer", "orders")}
    return catalogue.run(spark, "bronze", given).select(*_STATUS)


QUERIES = {
    "dq_domain_escapes": escapes,
    "dq_error_rows": error_rows,
    "dq_yaml_catalogue": yaml_catalogue,
    "dq_duplicate_keys": _issues("line_duplicates"),
    "dq_duplicate_keys_two_phase": duplicates_by_hash,
    "dq_domain_violations": _issues("event_domain"),
    "dq_location_codes": _issues("location_codes"),
    "dq_null_keys": _issues("unlabelled"),
    "dq_invalid_dates": _issues("invalid_order_dates"),
    "dq_invalid_amounts": _issues("invalid_amounts"),
    "dq_future_dates": _issues("future_dates"),
    "dq_pattern_violations": _issues("url_pattern"),
    "dq_date_order": _issues("date_order"),
    "dq_missing_category": _issues("missing_category"),
    "dq_orphan_facts": _issues("orphan_facts"),
    "dq_orphan_anti": unknown_products,
    "dq_check_metrics": dq_check_metrics,
    "dq_observed_metrics": dq_observed_metrics,
    "dq_layer_sql": dq_layer_sql,
    "dq_single_check": dq_single_check,
    "dq_status_tiered": lambda spark, sf: results(spark, sf, C.tiered()).select(*_STATUS),
    "dq_status_strict": lambda spark, sf: results(spark, sf, C.strict()).select(*_STATUS),
    "dq_status_flat": lambda spark, sf: results(spark, sf, C.flat()).select(*_STATUS),
    "dq_layer_overall": lambda spark, sf: C.layer_summary(results(spark, sf, C.tiered())),
    "dq_concurrent": dq_concurrent,
    "dq_merge_results": dq_merge_results,
    "dq_weighted_score": lambda spark, sf: C.weighted_score(results(spark, sf, C.tiered())),
    "dq_report_lines": dq_report_lines,
    "ops_alerts": lambda spark, sf: C.alerts(results(spark, sf, C.tiered())),
    "sink_issue_counts": sink_issue_counts,
    "sink_json_summary": sink_json_summary,
    "sink_text_report": sink_text_report,
}

# --- SQL ----------------------------------------------------------------------------------


def _in(values):
    return ", ".join(f"'{v}'" for v in values)


ISSUE_SQL = {
    "line_duplicates": "SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "event_domain": f"SELECT event_id, event_type FROM events WHERE event_type NOT IN ({_in(EVENT_TYPES)})",
    "unlabelled": "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL",
    "invalid_order_dates": f"SELECT o_orderkey, order_date FROM ({CLEANSE_SQL['silver_int_dates']}) o WHERE order_date IS NULL AND o_orderkey IS NOT NULL",
    "invalid_amounts": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal <= 0",
    "future_dates": f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > DATE '{AS_OF}'",
    "url_pattern": f"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '{PLAIN_URL}')",
    "location_codes": f"SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE n_name NOT IN ({_in(STANDARD_LOCATIONS)})",
    "date_order": "SELECT l_orderkey, l_linenumber, o_orderdate, l_shipdate FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate",
    "missing_category": f"SELECT product_key, product_id, category_id FROM ({star.DIM_PRODUCT_SQL}) d WHERE category IS NULL",
    "customer_key_duplicates": f"SELECT customer_key, count(*) AS duplicate_count FROM ({star.DIM_CUSTOMER_SQL}) d GROUP BY customer_key HAVING count(*) > 1",
    "orphan_facts": f"""SELECT f.order_number, f.line, f.customer_key, f.product_key, c.customer_id, p.product_id
        FROM ({star.FACT_SQL}) f
        LEFT JOIN ({star.DIM_CUSTOMER_SQL}) c ON c.customer_key = f.customer_key
        LEFT JOIN ({star.DIM_PRODUCT_SQL}) p ON p.product_key = f.product_key
        WHERE c.customer_id IS NULL OR p.product_id IS NULL""",
    "orphan_lines": f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM ({RAW_PARTS_SQL}) p WHERE p.end_date IS NULL AND p.p_partkey = l.l_partkey)",
}

ISSUE_SQL |= {
    "idle_customers": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)",
    "large_orders": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000",
    "nameless": "SELECT * FROM customer WHERE c_name IS NULL",
}

TABLE_SQL = {
    "silver.customer": "customer",
    "silver.orders": "orders",
    "labelled_documents": "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "order_dates": "orders",
    "customer_locations": "customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "dated_lines": "lineitem LEFT JOIN orders ON l_orderkey = o_orderkey",
    "dim_product": f"({star.DIM_PRODUCT_SQL}) d",
    "dim_customer": f"({star.DIM_CUSTOMER_SQL}) d",
    "fact": f"({star.FACT_SQL}) f",
}

_TIERED_SQL = """CASE WHEN clean_pct >= 95 THEN 'PASS'
     WHEN severity = 'critical' OR (severity = 'high' AND clean_pct < 90) OR (severity = 'medium' AND clean_pct < 85) THEN 'FAIL'
     ELSE 'WARNING' END"""
_STRICT_SQL = "CASE WHEN issues_found = 0 THEN 'PASS' ELSE 'FAIL' END"
_FLAT_SQL = "CASE WHEN clean_pct >= 95 THEN 'PASS' ELSE 'FAIL' END"


def results_sql(status, checks=CHECKS, first=0):
    """SQL of the results of `checks`."""
    counted = " UNION ALL ".join(
        f"""SELECT CAST({first + i} AS INTEGER) AS check_pos, '{c.name}' AS check_name, '{c.table}' AS table_name,
            '{c.severity}' AS severity, '{c.description.replace("'", "''")}' AS description,
            (SELECT count(*) FROM {TABLE_SQL.get(c.table, c.table)}) AS total_records,
            (SELECT count(*) FROM ({ISSUE_SQL[c.name]}) i) AS issues_found"""
        for i, c in enumerate(checks)
    )
    return f"""SELECT check_pos, check_name, table_name, severity, description, total_records, issues_found,
          total_records - issues_found AS clean_records,
          CAST(printf('%.2f', clean_pct) AS DOUBLE) AS clean_percentage, CAST(printf('%.2f', issue_pct) AS DOUBLE) AS issue_percentage, {status} AS status
        FROM (SELECT *, CASE WHEN total_records > 0 THEN (total_records - issues_found) / total_records * 100 ELSE 0.0 END AS clean_pct,
                     CASE WHEN total_records > 0 THEN issues_found / total_records * 100 ELSE 0.0 END AS issue_pct
              FROM ({counted}) c) m"""


def _lines_sql(source, lines, section):
    return " UNION ALL ".join(
        f"SELECT CAST({section} AS INTEGER) AS section, CAST({i} AS INTEGER) AS line_no, {text} AS line FROM {source}"
        for i, text in enumerate(lines)
    )


_SUMMARY_SQL = """SELECT count(*) AS total_checks,
          count(CASE WHEN status = 'PASS' THEN 1 END) AS passed_checks,
          count(CASE WHEN status = 'FAIL' THEN 1 END) AS failed_checks,
          count(CASE WHEN status = 'ERROR' THEN 1 END) AS error_checks,
          CASE WHEN count(CASE WHEN status = 'ERROR' THEN 1 END) > 0 THEN 'ERROR'
               WHEN count(CASE WHEN status = 'FAIL' THEN 1 END) > 0 THEN 'FAIL'
               WHEN count(CASE WHEN status = 'WARNING' THEN 1 END) > 0 THEN 'WARNING' ELSE 'PASS' END AS overall_status"""

_METRIC_LINES = [
    "'  Total Records: ' || total_records",
    "'  Issues Found: ' || issues_found",
    "'  Clean Records: ' || clean_records",
    "'  Clean Percentage: ' || CAST(clean_percentage AS VARCHAR) || '%'",
    "'  Issue Percentage: ' || CAST(issue_percentage AS VARCHAR) || '%'",
    "'  Status: ' || status",
]
_LONG_BLOCK = ["'Check: ' || check_name", "'  Description: ' || description", "'  Severity: ' || severity", *_METRIC_LINES]


def _report_sql():
    block = _lines_sql("r", _LONG_BLOCK, "check_pos + 1") + " UNION ALL " + (
        # the blank line keeps its place after the line an error would take
        "SELECT CAST(check_pos + 1 AS INTEGER), 10, '' FROM r"
    )
    head = _lines_sql("s", ["'Quality Report for SILVER Layer'", f"'{'=' * 50}'", "''"], 0)
    foot = _lines_sql(
        "s",
        [
            "'OVERALL SUMMARY'", f"'{'-' * 20}'", "'Total Checks: ' || total_checks", "'Passed: ' || passed_checks",
            "'Failed: ' || failed_checks", "'Errors: ' || error_checks", "'Overall Status: ' || overall_status",
        ],
        "total_checks + 1",
    )
    return f"""WITH r AS ({results_sql(_TIERED_SQL)}), s AS ({_SUMMARY_SQL} FROM r)
        SELECT section, line_no, line FROM ({head} UNION ALL {block} UNION ALL {foot}) t"""


def _text_report_sql():
    lines = _lines_sql("r", ["'Check: ' || check_name", *_METRIC_LINES, "''"], "check_pos + 1")
    head = " UNION ALL ".join(
        f"SELECT 0, 0, {t}" for t in ("'Quality Report for SILVER Layer'", f"'{'=' * 40}'", "''")
    )
    return f"""WITH r AS ({results_sql(_STRICT_SQL, CHECKS[:9])})
        SELECT line, count(*) AS n FROM ({lines} UNION ALL {head}) t GROUP BY line"""


def _status_sql(status):
    return f"SELECT {', '.join(_STATUS)} FROM ({results_sql(status)}) r"


SQL = {
    "dq_domain_escapes": """
        SELECT 'odd_types' AS check_name, count(*) AS total_records,
               count(CASE WHEN event_type NOT IN ('view', 'click') THEN 1 END) AS issues_found FROM events
        UNION ALL SELECT 'odd_addresses', count(*),
               count(CASE WHEN page_id % 3 = 0 OR NOT starts_with(url, 'https://') OR contains(url, chr(39))
                          OR contains(url, chr(92)) OR length(url) < 9 THEN 1 END) FROM pages""",
    "dq_error_rows": """
        SELECT 'good' AS check_name, count(*) AS total_records, count(*) - count(value) AS issues_found,
               CASE WHEN count(value) = count(*) THEN 'PASS' ELSE 'FAIL' END AS status, false AS failed FROM events
        UNION ALL SELECT name, 0, 0, 'ERROR', true FROM (VALUES ('no_column'), ('no_table'), ('fails')) v(name)""",
    "dq_yaml_catalogue": f"""
        WITH counted AS (
          SELECT 'low_balances' AS check_name, 'high' AS severity, (SELECT count(*) FROM customer) AS total,
                 (SELECT count(*) FROM customer WHERE c_acctbal < 1000) AS issues_found
          UNION ALL
          SELECT 'open_orders', 'medium', (SELECT count(*) FROM orders),
                 (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F')),
        rated AS (SELECT *, (total - issues_found) / total * 100 AS clean_pct FROM counted)
        SELECT check_name, severity, issues_found, CAST(printf('%.2f', clean_pct) AS DOUBLE) AS clean_percentage,
               {_TIERED_SQL.replace('95', '30')} AS status FROM rated""",
    "dq_duplicate_keys": ISSUE_SQL["line_duplicates"],
    "dq_duplicate_keys_two_phase": ISSUE_SQL["line_duplicates"],
    "dq_domain_violations": ISSUE_SQL["event_domain"],
    "dq_location_codes": ISSUE_SQL["location_codes"],
    "dq_null_keys": ISSUE_SQL["unlabelled"],
    "dq_invalid_dates": ISSUE_SQL["invalid_order_dates"],
    "dq_invalid_amounts": ISSUE_SQL["invalid_amounts"],
    "dq_future_dates": ISSUE_SQL["future_dates"],
    "dq_pattern_violations": ISSUE_SQL["url_pattern"],
    "dq_date_order": ISSUE_SQL["date_order"],
    "dq_missing_category": ISSUE_SQL["missing_category"],
    "dq_orphan_facts": ISSUE_SQL["orphan_facts"],
    "dq_orphan_anti": ISSUE_SQL["orphan_lines"],
    "dq_check_metrics": results_sql(_TIERED_SQL),
    "dq_observed_metrics": results_sql(_TIERED_SQL, OBSERVED),
    "dq_layer_sql": results_sql(_FLAT_SQL, SQL_CHECKS),
    "dq_single_check": results_sql(_FLAT_SQL, (BY_NAME["date_order"],)),
    "dq_status_tiered": _status_sql(_TIERED_SQL),
    "dq_status_strict": _status_sql(_STRICT_SQL),
    "dq_status_flat": _status_sql(_FLAT_SQL),
    "dq_concurrent": f"{_SUMMARY_SQL} FROM ({results_sql(_TIERED_SQL)}) r",
    "dq_layer_overall": f"{_SUMMARY_SQL} FROM ({results_sql(_TIERED_SQL)}) r",
    "dq_merge_results": f"""
        SELECT check_pos, check_name, issues_found, status FROM ({results_sql(_TIERED_SQL, CHECKS[:6])}) a
        UNION ALL
        SELECT check_pos, check_name, issues_found, status FROM ({results_sql(_STRICT_SQL, CHECKS[6:], 6)}) b""",
    "dq_weighted_score": f"""
        SELECT round(sum(w * clean_percentage) / nullif(sum(w), 0), 4) AS weighted_score FROM (
          SELECT clean_percentage, CASE severity WHEN 'critical' THEN 1.0::DOUBLE WHEN 'high' THEN 0.8::DOUBLE
                 WHEN 'medium' THEN 0.6::DOUBLE WHEN 'low' THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END AS w
          FROM ({results_sql(_TIERED_SQL)}) r) x""",
    "dq_report_lines": _report_sql(),
    "ops_alerts": f"""
        SELECT check_pos, check_name, table_name, severity, status,
               'check ' || check_name || ' on ' || table_name || ': ' || status || ', ' || issues_found
                 || ' of ' || total_records || ' rows' AS message
        FROM ({results_sql(_TIERED_SQL)}) r WHERE status IN ('FAIL', 'ERROR')""",
    "sink_issue_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, count(*) AS issues_found FROM ({ISSUE_SQL[n]}) i"
        for n in ("event_domain", "line_duplicates", "future_dates", "orphan_facts")
    ),
    "sink_json_summary": results_sql(_TIERED_SQL),
    "sink_text_report": _text_report_sql(),
}
