"""Tables replaced as a whole: write a version, audit it, then point the table at it.

A version is a folder of its own below the table's. Readers see the table through its location in the
catalogue, which moves to the new folder in one step and only if the audit found nothing. Who has
planned a read already goes on with the folder it began with; older versions stay until pruned by hand
and can be published again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.operators.checks import Check, Policy, check_results, strict
from layerkit.operators.contracts import Contract, check_contract

#: Says what is wrong with a version, a line per finding.
Audit = Callable[[DataFrame], Sequence[str]]


class AuditFailed(Exception):
    """A version was not published. `path` is where it lies, `findings` say why."""

    def __init__(self, table: str, path: str, findings: Sequence[str]):
        super().__init__(f"{table}: " + "; ".join(findings))
        self.path, self.findings = path, list(findings)


def keeps(contract: Contract) -> Audit:
    """Findings are the broken rules of the contract."""

    def audit(df: DataFrame) -> list[str]:
        broken = check_contract(df, contract).where("status = 'FAIL'").orderBy("column_name", "rule")
        return [f"{r['column_name']} {r['rule']}: {r['failures']}" for r in broken.collect()]

    return audit


def passes(checks: Sequence[Check], policy: Policy | None = None) -> Audit:
    """Findings are the checks that fail on the version, all of whose tables it stands for."""

    def audit(df: DataFrame) -> list[str]:
        results = check_results(df.sparkSession, checks, {c.table: df for c in checks}, policy or strict())
        failed = results.where(F.col("status").isin("FAIL", "ERROR")).orderBy("check_pos")
        return [f"{r['check_name']}: {r['error'] or r['issues_found']}" for r in failed.collect()]

    return audit


def write_version(df: DataFrame, root: str, table: str) -> str:
    """Write `df` as a new version of `table` (layer.name), which nobody reads yet; its folder."""
    layer, name = table.split(".")
    path = f"{root}/{layer}/{name}/version-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def point_to(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Make `table` read the version at `path`, also an older one. The layout has to be the table's."""
    quoted = path.replace("'", "\\'")
    rows = spark.read.parquet(path)
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{quoted}'")
    else:
        layout = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
        if layout != [(f.name, f.dataType) for f in rows.schema.fields]:
            raise AuditFailed(table, path, ["layout differs from the table's"])
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted}'")
        spark.catalog.refreshTable(table)
    return spark.table(table)


def publish(df: DataFrame, root: str, table: str, audits: Sequence[Audit] = ()) -> DataFrame:
    """Write a version of `table`, audit what was written, and point the table at it.

    If an audit finds anything, `AuditFailed` is raised and the table reads as before, or is still
    missing. Returns the table as published.
    """
    spark = df.sparkSession
    path = write_version(df, root, table)
    written = spark.read.schema(df.schema).parquet(path)
    findings = [line for audit in audits for line in audit(written)]
    if findings:
        raise AuditFailed(table, path, findings)
    return point_to(spark, table, path)
