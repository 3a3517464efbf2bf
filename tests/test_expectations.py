import datetime as dt
import json

import pytest

from layerkit.operators import expectations as E
from layerkit.operators.contracts import Contract, ContractError, Field, check_contract, enforce, outcome


@pytest.fixture
def df(spark):
    rows = [(1, "a", 5, dt.date(2024, 1, 1)), (2, "b", 11, None), (2, None, None, None), (None, "z", 0, None)]
    return spark.createDataFrame(rows, "id int, code string, v int, d date")


def by_pos(frame):
    return [r for r in frame.orderBy("expectation_pos").collect()]


def test_every_type(df):
    suite = E.Suite("s", [
        E.row_count_between(1, 3), E.row_count_between(4, 4), E.not_null("id"), E.unique("id"),
        E.in_set("code", ["a", "b"]), E.between("v", 0, 10), E.of_type("id", "INTEGER"),
        E.of_type("v", "FLOAT"), E.of_type("d", "DATE"), E.not_null("gone"), E.unique("gone"),
    ])
    rows = by_pos(E.validate(df, suite))
    assert [r.success for r in rows] == [False, True, False, False, False, False, True, False, True, False, False]
    assert [r.unexpected_count for r in rows[2:6]] == [1, 2, 1, 1]
    assert [r.missing_count for r in rows[2:6]] == [0, 1, 1, 1]
    assert rows[3].unexpected_percent == pytest.approx(200 / 3)
    assert rows[0].observed == "4" and rows[7].observed == "int"
    assert "gone" in rows[9].message and {r.element_count for r in rows} == {4}
    assert by_pos(E.validate(df, suite, families=True))[7].success


def test_row_expectations_share_one_scan(spark, sf, explained):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    suite = E.Suite("s", [E.row_count_between(1), E.not_null("o_orderkey"), E.in_set("o_orderstatus", ["F"]),
                          E.between("o_totalprice", 0), E.of_type("o_orderkey", "INTEGER")])
    assert explained(E.validate(orders, suite)).count("Scan parquet") <= 2


def test_unknown_types_and_empty_suites_raise(df):
    for items in ([E.of_type("id", "BLOB")], [E.Expectation("expect_magic", {"column": "id"})], []):
        with pytest.raises(ValueError):
            E.validate(df, E.Suite("s", items))


def test_suite_file(df, tmp_path):
    spec = {"expectation_suite_name": "f", "expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "id"}, "meta": {}}]}
    (tmp_path / "s.json").write_text(json.dumps(spec))
    suite = E.load_suite(str(tmp_path / "s.json"))
    assert E.validate(df, suite).first().suite == "f"


def test_checkpoint_is_stored_under_its_run_name(spark, df, tmp_path):
    at = dt.datetime(2024, 5, 6, 7, 8, 9)
    suites = [(df, E.Suite("a", [E.not_null("id")])), (df, E.Suite("b", [E.unique("code")]))]
    got = E.run_checkpoint("silver", suites, str(tmp_path), at)
    assert {(r.suite, r.success, r.run_name) for r in got.collect()} == {
        ("a", False, "20240506-070809-silver-quality-check"), ("b", True, "20240506-070809-silver-quality-check")}
    assert (tmp_path / "20240506-070809-silver-quality-check").is_dir()


def test_contract(spark, df, tmp_path):
    contract = Contract("c", {
        "id": Field(("int",), nullable=False, unique=True),
        "code": Field(("string",), isin=("a", "b")),
        "v": Field(("double",)),
        "gone": Field(("int",), nullable=False),
    })
    rules = check_contract(df, contract)
    got = {(r.column_name, r.rule): r.failures for r in rules.collect()}
    assert got == {("id", "type"): 0, ("id", "not_null"): 1, ("id", "unique"): 2, ("code", "type"): 0,
                   ("code", "isin"): 1, ("v", "type"): 1, ("gone", "type"): 1}
    row = outcome(rules).first()
    assert row.status == "FAIL" and "id unique: 2" in row.message
    with pytest.raises(ContractError):
        enforce(df, contract, str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "c")).first().status == "FAIL"
    assert enforce(df, contract, strict=False).first().status == "FAIL"
    good = Contract("g", {"code": Field(("string",), unique=True)})
    assert enforce(df, good).first().message == "Validation successful"


def test_published_row_ceilings_grow_on_demand():
    from layerkit.plans import quality

    table = "silver.crm_prd_info"
    assert quality.layer_suites("silver")[table] == quality.SUITES[table]
    grown = quality.layer_suites("silver", 100)[table].expectations
    assert grown[0].kwargs == {"min_value": 100, "max_value": 1_000_000}
    assert grown[1:] == quality.SUITES[table].expectations[1:]
