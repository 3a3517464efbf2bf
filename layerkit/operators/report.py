"""Reports and issue exports of a checked layer."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.operators.checks import Check, Tables, issue_rows, layer_summary
from layerkit.sources.csv import write_csv

# report layouts (fixed values)
STRICT_RULE = "=" * 40
TIERED_RULE = "=" * 50
SUMMARY_RULE = "-" * 20


def _lines(*lines: Column) -> Column:
    return F.posexplode(F.array(*lines))


def _text(label: str, value: Column, suffix: str = "") -> Column:
    return F.concat(F.lit(label), value.cast("string"), F.lit(suffix))


def report_lines(results: DataFrame, layer: str, generated: Column | None = None, detailed: bool = True) -> DataFrame:
    """The text report as (section, line_no, line), to be ordered by both: a header, a block
    per check in catalogue order and, if `detailed`, description, severity, error and an
    overall summary. `generated` is a formatted time for the header. The results are read more
    than once, so they should come from `run_checks`."""
    empty = F.lit("")
    head = [
        F.lit(f"Quality Report for {layer.upper()} Layer"),
        F.lit(TIERED_RULE if detailed else STRICT_RULE),
        empty,
    ]
    if generated is not None:
        head += [F.concat(F.lit("Generated: "), generated), empty]
    block = [_text("Check: ", F.col("check_name"))]
    if detailed:
        known = F.col("error").isNull()
        block += [
            _text("  Description: ", F.when(known, F.col("description")).otherwise("N/A")),
            _text("  Severity: ", F.when(known, F.col("severity")).otherwise("N/A")),
        ]
    block += [
        _text("  Total Records: ", F.col("total_records")),
        _text("  Issues Found: ", F.col("issues_found")),
        _text("  Clean Records: ", F.col("clean_records")),
        _text("  Clean Percentage: ", F.col("clean_percentage"), "%"),
        _text("  Issue Percentage: ", F.col("issue_percentage"), "%"),
        _text("  Status: ", F.col("status")),
    ]
    if detailed:
        block.append(F.when(F.col("error").isNotNull(), F.concat(F.lit("  Error: "), "error")))
    block.append(empty)

    columns = ["section", "line_no", "line"]
    summary = layer_summary(results)
    header = summary.select(F.lit(0).alias("section"), _lines(*head).alias("line_no", "line"))
    checks = results.select((F.col("check_pos") + 1).alias("section"), _lines(*block).alias("line_no", "line"))
    out = header.select(*columns).unionByName(checks.where("line is not null").select(*columns))
    if detailed:
        foot = [
            F.lit("OVERALL SUMMARY"),
            F.lit(SUMMARY_RULE),
            _text("Total Checks: ", F.col("total_checks")),
            _text("Passed: ", F.col("passed_checks")),
            _text("Failed: ", F.col("failed_checks")),
            _text("Errors: ", F.col("error_checks")),
            _text("Overall Status: ", F.col("overall_status")),
        ]
        section = (F.col("total_checks") + 1).cast("int").alias("section")
        out = out.unionByName(summary.select(section, _lines(*foot).alias("line_no", "line")).select(*columns))
    return out


def write_report(results: DataFrame, layer: str, path: str, detailed: bool = True) -> None:
    """Write the text report, about ten lines per check, as one file in folder `path`."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if detailed else None
    lines = report_lines(results, layer, now, detailed)
    lines.coalesce(1).sortWithinPartitions("section", "line_no").select("line").write.mode("overwrite").text(path)


def write_summary(results: DataFrame, path: str) -> None:
    """One JSON object per check below `path`/checks and one for the layer below
    `path`/overall."""
    keep = {"ignoreNullFields": False}
    results.coalesce(1).sortWithinPartitions("check_pos").write.mode("overwrite").json(f"{path}/checks", **keep)
    layer_summary(results).coalesce(1).write.mode("overwrite").json(f"{path}/overall", **keep)


def write_issues(
    spark: SparkSession,
    checks: Sequence[Check],
    folder: str,
    tables: Tables | None = None,
    names: Mapping[str, str] | None = None,
    clean: Collection[str] = (),
) -> Mapping[str, str]:
    """Issue rows of every check as a CSV folder below `folder`, written by the executors and
    named by `names` or after the check. Checks named in `clean` are known to have no issues
    and get a header without a scan. Returns why a check's rows could not be written, for those
    that failed."""
    problems = {}
    for check in checks:
        try:
            rows = issue_rows(spark, check, tables)
            write_csv(rows.where("false") if check.name in clean else rows, f"{folder}/{(names or {}).get(check.name, check.name)}")
        except Exception as error:  # noqa: BLE001 - a failed export is only a warning
            problems[check.name] = str(error).splitlines()[0]
    return problems
