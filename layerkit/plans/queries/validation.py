"""Expectation suites and contracts."""

from __future__ import annotations

import datetime as dt

from layerkit.operators import expectations as E
from layerkit.operators.contracts import Contract, Field, check_contract, outcome
from layerkit.plans.queries.data import table

SEGMENTS = ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")

ROW_COUNTS = {
    "customer": [E.row_count_between(1, 1_000_000_000)],
    "orders": [E.row_count_between(1, 10), E.row_count_between(10, None)],
}
NOT_NULL = {
    "customer": [E.not_null("c_custkey"), E.not_null("c_name"), E.not_null("c_email")],
    "lineitem": [E.not_null("l_orderkey"), E.not_null("l_shipdate")],
}
UNIQUE = {
    "customer": [E.unique("c_custkey"), E.unique("c_nationkey")],
    "orders": [E.unique("o_orderkey"), E.unique("o_custkey")],
    "lineitem": [E.unique("l_orderkey")],
}
IN_SET = {
    "customer": [E.in_set("c_mktsegment", SEGMENTS)],
    "orders": [E.in_set("o_orderstatus", ["F", "O", "P"])],
}
BETWEEN = {
    "customer": [E.between("c_acctbal", 0.0, 10000.0)],
    "lineitem": [E.between("l_quantity", 1, 50), E.between("l_extendedprice", 1000.0, 50000.0)],
}
OF_TYPE = {
    "customer": [
        E.of_type("c_custkey", "INTEGER"), E.of_type("c_nationkey", "INTEGER"),
        E.of_type("c_acctbal", "FLOAT"), E.of_type("c_name", "DATE"), E.of_type("c_birth", "DATE"),
    ],
}
EVERYTHING = {
    t: [e for group in (ROW_COUNTS, NOT_NULL, UNIQUE, IN_SET, BETWEEN, OF_TYPE) for e in group.get(t, [])]
    for t in ("customer", "orders", "lineitem")
}
TYPES = {
    "c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double", "c_name": "string",
    "c_mktsegment": "string",
}

CUSTOMER = Contract(
    "customer",
    {
        "c_custkey": Field(("int", "bigint"), nullable=False, unique=True),
        "c_name": Field(("string",), nullable=False, unique=True),
        "c_mktsegment": Field(("string",), isin=SEGMENTS),
        "c_acctbal": Field(("decimal",), nullable=False),
        "c_email": Field(("string",)),
    },
)


def _suite(name, expectations):
    return E.Suite(f"{name}_suite", expectations)


def _validated(groups, families=False):
    def query(spark, sf):
        batches = [(table(spark, sf, t), _suite(t, es)) for t, es in groups.items()]
        out = E.run_checkpoint("silver", batches, started=dt.datetime(2024, 1, 1), families=families)
        return out.drop("run_name")

    return query


def expect_checkpoint(spark, sf):
    batches = [(table(spark, sf, t), _suite(t, es)) for t, es in EVERYTHING.items()]
    return E.run_checkpoint("silver", batches, started=dt.datetime(2024, 1, 1))


QUERIES = {
    "expect_row_count": _validated(ROW_COUNTS),
    "expect_not_null": _validated(NOT_NULL),
    "expect_unique": _validated(UNIQUE),
    "expect_in_set": _validated(IN_SET),
    "expect_between": _validated(BETWEEN),
    "expect_of_type": _validated(OF_TYPE),
    "expect_of_type_family": _validated(OF_TYPE, families=True),
    "expect_checkpoint": expect_checkpoint,
    "contract_check": lambda spark, sf: check_contract(table(spark, sf, "customer"), CUSTOMER),
    "contract_outcome": lambda spark, sf: outcome(check_contract(table(spark, sf, "customer"), CUSTOMER)),
}

# --- SQL ----------------------------------------------------------------------------------

COLUMNS = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_shipdate", "l_quantity", "l_extendedprice"),
}
_ACCEPTED = {
    False: {"INTEGER": ("int",), "FLOAT": ("float", "double"), "DATE": ("date",)},
    True: {"INTEGER": ("int", "bigint"), "FLOAT": ("int", "bigint", "float", "double"), "DATE": ("date",)},
}


def _literal(v):
    return f"'{v}'" if isinstance(v, str) else str(v)


def _range_sql(value, kwargs):
    bounds = [f"{value} >= {_literal(kwargs['min_value'])}"] if kwargs["min_value"] is not None else []
    bounds += [f"{value} <= {_literal(kwargs['max_value'])}"] if kwargs["max_value"] is not None else []
    return " AND ".join(bounds) or "true"


def _line_sql(table_name, pos, e, families):
    n = f"(SELECT count(*) FROM {table_name})"
    column = e.column
    success, absent, unexpected, observed, message = "false", "NULL", "NULL", "NULL", "NULL"
    if column is not None and column not in COLUMNS[table_name]:
        message = f"'column {column} does not exist'"
    elif e.type == E.ROW_COUNT:
        success, observed = _range_sql(n, e.kwargs), f"CAST({n} AS VARCHAR)"
    elif e.type == E.OF_TYPE:
        success = str(TYPES[column] in _ACCEPTED[families][e.kwargs["type_"]]).lower()
        observed = f"'{TYPES[column]}'"
    else:
        if e.type == E.NOT_NULL:
            rows, absent = f"SELECT 1 FROM {table_name} WHERE {column} IS NULL", "0"
        elif e.type == E.IN_SET:
            values = ", ".join(map(_literal, e.kwargs["value_set"]))
            rows = f"SELECT 1 FROM {table_name} WHERE {column} NOT IN ({values})"
        elif e.type == E.BETWEEN:
            rows = f"SELECT 1 FROM {table_name} WHERE {column} IS NOT NULL AND NOT ({_range_sql(column, e.kwargs)})"
        else:
            rows = f"SELECT 1 FROM {table_name} WHERE {column} IN (SELECT {column} FROM {table_name} GROUP BY {column} HAVING count(*) > 1)"
        if absent == "NULL":
            absent = f"(SELECT count(*) FROM {table_name} WHERE {column} IS NULL)"
        unexpected = f"(SELECT count(*) FROM ({rows}) u)"
        success = f"{unexpected} = 0"
    return f"""SELECT '{table_name}_suite' AS suite, CAST({pos} AS INTEGER) AS expectation_pos, '{e.type}' AS expectation,
        CAST({_literal(column) if column else 'NULL'} AS VARCHAR) AS column_name, {success} AS success,
        {n} AS element_count, CAST({absent} AS BIGINT) AS missing_count, CAST({unexpected} AS BIGINT) AS unexpected_count,
        CAST({observed} AS VARCHAR) AS observed, CAST({message} AS VARCHAR) AS message"""


def _suites_sql(groups, families=False, extra=""):
    lines = " UNION ALL ".join(
        _line_sql(t, pos, e, families) for t, es in groups.items() for pos, e in enumerate(es)
    )
    return f"""SELECT suite, expectation_pos, expectation, column_name, success, element_count, missing_count,
          unexpected_count,
          CASE WHEN unexpected_count IS NULL THEN NULL
               WHEN element_count - missing_count > 0 THEN unexpected_count / (element_count - missing_count) * 100
               ELSE 0.0 END AS unexpected_percent,
          observed, message{extra}
        FROM ({lines}) l"""


CONTRACT_SQL = """
  SELECT 'customer' AS contract, column_name, rule, CAST(failures AS BIGINT) AS failures,
         CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM (
    SELECT 'c_custkey' AS column_name, 'type' AS rule, 0 AS failures
    UNION ALL SELECT 'c_name', 'type', 0
    UNION ALL SELECT 'c_mktsegment', 'type', 0
    UNION ALL SELECT 'c_acctbal', 'type', 1
    UNION ALL SELECT 'c_email', 'type', 1
    UNION ALL SELECT 'c_custkey', 'not_null', count(*) FROM customer WHERE c_custkey IS NULL
    UNION ALL SELECT 'c_name', 'not_null', count(*) FROM customer WHERE c_name IS NULL
    UNION ALL SELECT 'c_custkey', 'unique', coalesce(sum(n), 0)
      FROM (SELECT count(*) AS n FROM customer WHERE c_custkey IS NOT NULL GROUP BY c_custkey HAVING count(*) > 1) a
    UNION ALL SELECT 'c_name', 'unique', coalesce(sum(n), 0)
      FROM (SELECT count(*) AS n FROM customer WHERE c_name IS NOT NULL GROUP BY c_name HAVING count(*) > 1) b
    UNION ALL SELECT 'c_mktsegment', 'isin', count(*) FROM customer
      WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD', 'MACHINERY')
  ) r
"""

SQL = {
    "expect_row_count": _suites_sql(ROW_COUNTS),
    "expect_not_null": _suites_sql(NOT_NULL),
    "expect_unique": _suites_sql(UNIQUE),
    "expect_in_set": _suites_sql(IN_SET),
    "expect_between": _suites_sql(BETWEEN),
    "expect_of_type": _suites_sql(OF_TYPE),
    "expect_of_type_family": _suites_sql(OF_TYPE, families=True),
    "expect_checkpoint": _suites_sql(EVERYTHING, extra=", '20240101-000000-silver-quality-check' AS run_name"),
    "contract_check": CONTRACT_SQL,
    "contract_outcome": f"""
        SELECT contract, CASE WHEN max(failures) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
               CASE WHEN max(failures) = 0 THEN 'Validation successful'
                    ELSE string_agg(column_name || ' ' || rule || ': ' || failures, '; '
                                    ORDER BY column_name || ' ' || rule || ': ' || failures)
                         FILTER (WHERE failures > 0) END AS message
        FROM ({CONTRACT_SQL}) c GROUP BY contract""",
}
