import pytest
from pyspark.sql import functions as F

from layerkit.operators import checks as C
from layerkit.operators.report import report_lines, write_issues, write_report, write_summary
from layerkit.sources.catalogue import load_catalogue
from layerkit.sources.csv import count_csv_rows

YAML = """
quality_checks:
  silver:
    - name: repeated
      table: t
      description: repeated keys
      issue_query: "SELECT k, COUNT(*) AS count FROM t GROUP BY k HAVING COUNT(*) > 1"
      csv_file: /out/repeated.csv
      severity: high
    - {name: plain, table: t, issue_query: "SELECT * FROM t WHERE v < 0"}
  gold: []
quality_thresholds:
  pass_threshold: 97.5
  severity_weights: {critical: 1.0, high: 0.5}
"""


def status(spark, policy, cases):
    rows = [(float(p), s, i) for i, (p, s) in enumerate(cases)]
    df = spark.createDataFrame(rows, "p double, s string, i int")
    out = df.select("i", policy(F.lit(1), F.col("p"), F.col("s")).alias("st")).orderBy("i")
    return [r.st for r in out.collect()]


def results(spark, *statuses, start=0):
    rows = [
        (start + i, f"c{i}", "t", "high", "", 10, 1, 9, 90.0, 10.0, s, None) for i, s in enumerate(statuses)
    ]
    return spark.createDataFrame(rows, C.RESULT_SCHEMA)


@pytest.fixture
def table(spark):
    rows = [(i, i % 50, "n/a" if i % 2 else "Road") for i in range(98)] + [(98, None, None), (99, None, "Bad")]
    return spark.createDataFrame(rows, "id int, k int, line string")


def test_status_policies(spark):
    cases = [(98, "medium"), (95, "high"), (90, "critical"), (80, "high"), (70, "medium"),
             (90, "high"), (85, "medium"), (0, "low"), (94.999, "critical"), (89.9, "high")]
    want = ["PASS", "PASS", "FAIL", "FAIL", "FAIL", "WARNING", "WARNING", "WARNING", "FAIL", "FAIL"]
    assert status(spark, C.tiered(), cases) == want
    assert status(spark, C.flat(), [(95, "low"), (94.99, "low")]) == ["PASS", "FAIL"]
    assert status(spark, C.strict(), [(100, "low")]) == ["FAIL"]


def test_metrics_of_two_issues_in_a_hundred(spark, table):
    check = C.missing("k", name="nokey", table="t", severity="high", description="key")
    row = C.run_checks(spark, [check], {"t": table}).first()
    assert (row.total_records, row.issues_found, row.clean_records) == (100, 2, 98)
    assert (row.clean_percentage, row.issue_percentage, row.status) == (98.0, 2.0, "PASS")
    one = C.layer_summary(C.run_checks(spark, [check], {"t": table})).first()
    assert (one.total_checks, one.passed_checks, one.overall_status) == (1, 1, "PASS")


def test_percentages_round_the_stored_double(spark):
    values = [48.595, 80.605, 51.405, 0.125, 0.375, 99.995, 100.0, 1e-9, -1234.565] + [i / 6 for i in range(600)]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r.y for r in df.select("x", C.two_decimals(F.col("x")).alias("y")).collect()]
    assert got == [round(v, 2) for v in values]


def test_duplicates_count_keys_with_null_as_one(spark, table):
    check = C.DuplicateCheck(name="dup", table="t", keys=["k"])
    row = C.run_checks(spark, [check], {"t": table}).first()
    assert (row.total_records, row.issues_found) == (100, 49)
    assert C.issue_rows(spark, check, {"t": table}).where("k is null").first()["count"] == 2


def test_domain_ignores_null(spark, table):
    check = C.outside_domain("line", ["Road", "n/a"], name="line", table="t", show=["id", "line"])
    assert [tuple(r) for r in C.issue_rows(spark, check, {"t": table}).collect()] == [(99, "Bad")]


def test_row_checks_share_one_scan(spark, explained, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet")
    group = [
        C.missing("o_orderdate", name="a", table="o"),
        C.not_positive("o_totalprice", name="b", table="o"),
        C.later_than("o_orderdate", "2001-01-01", name="c", table="o"),
    ]
    assert explained(C.check_results(spark, group, {"o": df})).count("Scan parquet") <= 2


def test_empty_table_never_passes_tiered(spark, table):
    check = C.missing("k", name="x", table="t", severity="critical")
    dup = C.DuplicateCheck(name="d", table="t", keys=["k"])
    rows = C.run_checks(spark, [check, dup], {"t": table.limit(0)}).collect()
    assert [(r.total_records, r.clean_percentage, r.status) for r in rows] == [(0, 0.0, "FAIL"), (0, 0.0, "FAIL")]


def test_failing_checks_become_error_rows(spark, table):
    group = [
        C.missing("nope", name="no_column", table="t"),
        C.missing("k", name="no_table", table="absent"),
        C.QueryCheck(name="bad_sql", table="t", issues="SELECT FROM WHERE"),
        C.RowCheck(name="fails_running", table="t", where="raise_error('boom') IS NULL"),
        C.missing("k", name="good", table="t"),
    ]
    rows = {r.check_name: r for r in C.run_checks(spark, group, {"t": table}).collect()}
    assert [rows[c.name].status for c in group] == ["ERROR"] * 4 + ["PASS"]
    assert rows["no_column"].error and rows["fails_running"].total_records == 0
    assert C.layer_summary(C.run_checks(spark, group, {"t": table})).first().overall_status == "ERROR"


def test_quotes_backslashes_and_nulls_in_checks(spark):
    df = spark.createDataFrame([("a\\b",), ("it's",), ("zzz",), (None,)], "s string")
    group = [C.outside_domain("s", ["a\\b", "it's", None], name="domain", table="t"),
             C.not_matching("s", r"^(a\\b|it's)$", name="pattern", table="t")]
    rows = C.run_checks(spark, group, {"t": df}).orderBy("check_pos").collect()
    assert [(r.total_records, r.issues_found) for r in rows] == [(4, 1), (4, 1)]


def test_statements_read_the_given_tables(spark, table):
    spark.range(100).createOrReplaceTempView("few")
    check = C.QueryCheck(name="q", table="few", issues="SELECT * FROM few WHERE id > 0")
    row = C.run_checks(spark, [check], {"few": spark.range(3)}).first()
    assert (row.total_records, row.issues_found) == (3, 2)
    assert C.run_checks(spark, [check], lambda _: table).first().status == "ERROR"


def test_a_table_is_counted_once(spark, table, explained):
    group = [C.QueryCheck(name="q", table="t", issues=lambda get: get("u")), C.missing("k", name="a", table="t"),
             C.DuplicateCheck(name="d", table="v", keys=["k"]), C.QueryCheck(name="r", table="v", issues=lambda get: get("u"))]
    given = {"t": table, "u": table.limit(2), "v": table}
    rows = C.run_checks(spark, group, given).orderBy("check_pos").collect()
    assert [(r.total_records, r.issues_found) for r in rows][0::3] == [(100, 2), (100, 2)]
    branches, _ = C._branches(spark, list(enumerate(group)), given)
    assert len(branches) == 4


def test_clean_plus_issues_is_total(spark, table):
    group = [C.missing("k", name="a", table="t"), C.RowCheck(name="b", table="t", where="id > 40")]
    for r in C.check_results(spark, group, {"t": table}, C.strict()).collect():
        assert r.clean_records + r.issues_found == r.total_records


@pytest.mark.parametrize(
    "given, want",
    [((), "PASS"), (("PASS", "PASS"), "PASS"), (("PASS", "FAIL"), "FAIL"), (("PASS", "ERROR", "FAIL"), "ERROR"),
     (("WARNING", "FAIL"), "FAIL"), (("PASS", "WARNING"), "WARNING")],
)
def test_overall_status(spark, given, want):
    assert C.layer_summary(results(spark, *given)).first().overall_status == want


def test_merge_last_wins_in_first_place(spark):
    first, second = results(spark, "PASS", "PASS"), results(spark, "FAIL")
    merged = C.merge_results(first, second).orderBy("check_pos")
    assert [(r.check_pos, r.check_name, r.status) for r in merged.collect()] == [(0, "c0", "FAIL"), (1, "c1", "PASS")]


def test_weighted_score_and_alerts(spark):
    df = results(spark, "PASS", "FAIL").withColumn("clean_percentage", F.when(F.col("check_pos") == 0, 100.0).otherwise(50.0))
    df = df.withColumn("severity", F.when(F.col("check_pos") == 0, "critical").otherwise("low"))
    assert C.weighted_score(df).first()[0] == pytest.approx((100 + 0.4 * 50) / 1.4, abs=1e-4)
    assert [r.check_name for r in C.alerts(df).collect()] == ["c1"]


def test_unknown_layer_and_name(spark):
    layers = {"silver": [C.missing("k", name="a", table="t")], "gold": []}
    assert C.check_names(layers, "silver") == ["a"]
    with pytest.raises(ValueError):
        C.run_check(spark, layers, "copper", "a")
    with pytest.raises(ValueError):
        C.run_check(spark, layers, "silver", "b")
    assert C.run_checks(spark, layers["gold"]).count() == 0


def test_yaml_catalogue(spark, table, tmp_path):
    (tmp_path / "c.yaml").write_text(YAML)
    catalogue = load_catalogue(str(tmp_path / "c.yaml"))
    assert catalogue.pass_threshold == 97.5 and catalogue.layers["gold"] == []
    assert catalogue.layers["silver"][1].severity == "medium"
    table.withColumn("v", F.col("id")).createOrReplaceTempView("t")
    rows = C.run_checks(spark, catalogue.layers["silver"]).orderBy("check_pos").collect()
    assert [(r.issues_found, r.status) for r in rows] == [(49, "FAIL"), (0, "PASS")]
    done = catalogue.run(spark, "silver", {"t": spark.table("t")})
    assert [r.issues_found for r in done.orderBy("check_pos").collect()] == [49, 0]
    assert catalogue.score(done).first()[0] is not None
    (tmp_path / "bad.yaml").write_text("quality_checks: {silver: [{name: x}]}")
    for name in ("bad.yaml", "absent.yaml"):
        with pytest.raises(C.CheckError):
            load_catalogue(str(tmp_path / name))


def test_reports(spark, table, tmp_path):
    group = [C.missing("k", name="nokey", table="t", severity="high", description="key"),
             C.missing("nope", name="broken", table="t")]
    done = C.run_checks(spark, group, {"t": table})
    write_report(done, "silver", str(tmp_path / "report"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert lines[0] == "Quality Report for SILVER Layer" and lines[1] == "=" * 50
    at = lines.index("Check: nokey")
    assert lines[at + 1 : at + 9] == [
        "  Description: key", "  Severity: high", "  Total Records: 100", "  Issues Found: 2",
        "  Clean Records: 98", "  Clean Percentage: 98.0%", "  Issue Percentage: 2.0%", "  Status: PASS",
    ]
    assert lines[-1] == "Overall Status: ERROR" and any(x.startswith("  Error: ") for x in lines)
    plain = [r.line for r in report_lines(done, "gold", detailed=False).orderBy("section", "line_no").collect()]
    assert plain[:3] == ["Quality Report for GOLD Layer", "=" * 40, ""] and plain[4] == "  Total Records: 100"
    write_summary(done, str(tmp_path / "summary"))
    assert spark.read.json(str(tmp_path / "summary/checks")).count() == 2
    assert spark.read.json(str(tmp_path / "summary/overall")).first().error_checks == 1


def test_issue_export_and_row_counter(spark, table, tmp_path):
    group = [C.missing("k", name="nokey", table="t", show=["id", "k"]), C.missing("line", name="noline", table="t"),
             C.missing("nope", name="broken", table="t"),
             C.RowCheck(name="none", table="t", where="id < 0")]
    problems = write_issues(spark, group, str(tmp_path / "issues"), {"t": table.coalesce(1)})
    assert list(problems) == ["broken"]
    (tmp_path / "issues" / "empty.csv").write_text("")
    got = {r.path.split("issues/")[1].split("/")[0]: r.n for r in count_csv_rows(spark, str(tmp_path / "issues")).collect()}
    assert got == {"nokey": 2, "noline": 1, "none": 0, "empty.csv": 0}


def test_sql_text_leaves_the_session_alone(spark, table):
    spark.range(7).createOrReplaceTempView("mine")
    before = {t.name for t in spark.catalog.listTables()}
    group = [C.QueryCheck(name="own", table="mine", issues="SELECT * FROM mine"),
             C.QueryCheck(name="dotted", table="silver.mine", issues="select * FROM silver . mine m /* silver.mine */ WHERE 'silver.mine' <> '' AND Silver.Mine.k IS NULL;"),
             C.QueryCheck(name="with", table="mine", issues="WITH a AS (SELECT * FROM mine) SELECT * FROM a ORDER BY id -- end")]
    group[1] = C.QueryCheck(name="dotted", table="silver.mine", issues=group[1].issues.replace("mine m /", "mine /"))
    done = C.run_checks(spark, group, {"mine": table.limit(5), "silver.mine": table})
    assert [(r.check_name, r.issues_found, r.error) for r in done.orderBy("check_pos").collect()] == [
        ("own", 5, None), ("dotted", 2, None), ("with", 5, None)]
    assert {t.name for t in spark.catalog.listTables()} == before and spark.table("mine").count() == 7
    spark.catalog.dropTempView("mine")


def test_one_failing_check_among_many_is_found_by_halves(spark, table):
    group = [C.missing("k", name=f"c{i}", table="t") for i in range(64)]
    group[37] = C.RowCheck(name="c37", table="t", where="raise_error('broken') IS NULL")
    tracker, jobs = spark.sparkContext.statusTracker(), f"halves-{id(group)}"
    spark.sparkContext.setJobGroup(jobs, "halves")
    done = {r.check_name: r for r in C.run_checks(spark, group, {"t": table}, C.strict()).collect()}
    started = len(tracker.getJobIdsForGroup(jobs))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [n for n, r in done.items() if r.error] == ["c37"] and all(r.issues_found == 2 for n, r in done.items() if n != "c37")
    # a job that succeeds is two, one per stage, with adaptive execution
    assert 0 < started <= 28


def test_observed_checks(spark, table, tmp_path):
    group = [C.missing("k", name="nokey", table="t"), C.RowCheck(name="odd", table="t", where="id % 2 = 1"),
             C.missing("k", name="elsewhere", table="u")]
    watched = C.ObservedChecks(group)
    rows = watched.watch(table, "t")
    rows.write.parquet(str(tmp_path / "t"))
    got = watched.results(spark, C.strict()).drop("error").orderBy("check_pos").collect()
    want = C.check_results(spark, group[:2], {"t": table}, C.strict()).drop("error").orderBy("check_pos").collect()
    assert got[:2] == want and got[2].status == "ERROR"
    with pytest.raises(C.CheckError):
        C.ObservedChecks([C.DuplicateCheck(name="d", table="t", keys=["k"])])


def test_observed_checks_need_no_scan_of_their_own(spark, table, explained, tmp_path):
    table.write.parquet(str(tmp_path / "in"))
    watched = C.ObservedChecks([C.missing("k", name="nokey", table="t")])
    text = explained(watched.watch(spark.read.parquet(str(tmp_path / "in")), "t"))
    assert text.count("Scan parquet") == 2 and "Exchange" not in text  # once in the tree, once in the details


def test_results_restated_by_another_policy(spark, table):
    group = [C.missing("k", name="few", table="t", severity="low"), C.RowCheck(name="most", table="t", where="id > 3", severity="critical"),
             C.missing("nope", name="broken", table="t")]
    first = C.run_checks(spark, group, {"t": table}, C.strict())
    again = C.run_checks(spark, group, {"t": table}, C.tiered())
    assert C.restated(first, C.tiered()).orderBy("check_pos").collect() == again.orderBy("check_pos").collect()
    assert [r.status for r in first.orderBy("check_pos").collect()] == ["FAIL", "FAIL", "ERROR"]


def test_branches_run_at_the_same_time(spark, table):
    import threading

    both = threading.Barrier(2, timeout=60)

    def met(get):
        # the table is looked up before waiting, as lookups go one by one
        df = get("t")
        both.wait()
        return df.where("k IS NULL")

    branches = {n: [C.QueryCheck(name=f"{n}-meets", table="t", issues=met), C.missing("k", name=n, table="t")] for n in ("a", "b")}
    # a check is planned once to see whether it can be, and once to run
    got = C.run_concurrently(spark, branches, {"t": table}.__getitem__, C.strict()).orderBy("check_pos").collect()
    assert [(r.check_pos, r.check_name, r.issues_found, r.error) for r in got] == [
        (0, "a-meets", 2, None), (1, "a", 2, None), (2, "b-meets", 2, None), (3, "b", 2, None)]
    assert C.run_concurrently(spark, {}).count() == 0
