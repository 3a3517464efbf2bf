"""Data-quality checks: issue rows, metrics, status policies and layer summaries.

A check names a table and describes its issue rows. Metrics never move those rows: every
row-predicate check on a table is counted by one shared aggregate, duplicate checks by a
pre-aggregated group count, and the branches meet as one short row per check.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.operators.uniqueness import repeated_keys
from layerkit.session import few_rows

PASS_THRESHOLD = 95.0
SEVERITY_WEIGHTS = {"critical": 1.0, "high": 0.8, "medium": 0.6, "low": 0.4}
WORST_FIRST = ("ERROR", "FAIL", "WARNING", "PASS")

RESULT_SCHEMA = (
    "check_pos int, check_name string, table_name string, severity string, description string, "
    "total_records bigint, issues_found bigint, clean_records bigint, "
    "clean_percentage double, issue_percentage double, status string, error string"
)

Tables = Mapping[str, DataFrame] | Callable[[str], DataFrame]
Policy = Callable[[Column, Column, Column], Column]


class CheckError(Exception):
    """A check catalogue or check name that cannot be used."""


@dataclass(frozen=True, kw_only=True)
class Check:
    name: str
    table: str
    severity: str = "medium"
    description: str = ""


@dataclass(frozen=True, kw_only=True)
class RowCheck(Check):
    """Rows where `where` is true, SQL text or a function that makes the predicate; `show` limits the
    columns reported."""

    where: str | Callable[[], Column]
    show: Sequence[str] = ()


@dataclass(frozen=True, kw_only=True)
class DuplicateCheck(Check):
    """Keys that occur more than once, NULL being one key. Counts keys, not rows. `near_unique` is for tables
    that have few such keys: only keys of repeated hashes are shuffled, at the price of a pass that runs
    while the check is planned."""

    keys: Sequence[str]
    count_as: str = "count"
    near_unique: bool = False


@dataclass(frozen=True, kw_only=True)
class QueryCheck(Check):
    """Issue rows from SQL text or from a function of the tables."""

    issues: str | Callable[[Callable[[str], DataFrame]], DataFrame]


def _predicate(check: RowCheck) -> Column:
    return F.expr(check.where) if isinstance(check.where, str) else check.where()


def outside_domain(column: str, values: Iterable[str | None], **check) -> RowCheck:
    """Values not in a fixed list; NULL is not an issue, neither in the column nor in the list."""
    known = [v for v in values if v is not None]
    return RowCheck(where=lambda: F.col(column).isNotNull() & ~F.col(column).isin(known), **check)


def missing(column: str, **check) -> RowCheck:
    return RowCheck(where=f"{column} IS NULL", **check)


def missing_beside(column: str, key: str, **check) -> RowCheck:
    """`column` is NULL although `key` is not."""
    return RowCheck(where=f"{column} IS NULL AND {key} IS NOT NULL", **check)


def not_positive(column: str, **check) -> RowCheck:
    return RowCheck(where=f"{column} <= 0", **check)


def later_than(column: str, as_of: str, **check) -> RowCheck:
    """Dates after `as_of` (yyyy-mm-dd)."""
    return RowCheck(where=f"{column} > DATE '{as_of}'", **check)


def out_of_order(start: str, end: str, **check) -> RowCheck:
    """`end` lies before `start`."""
    return RowCheck(where=f"{end} < {start}", **check)


def not_matching(column: str, pattern: str, **check) -> RowCheck:
    """Values in which the regular expression finds no match; NULL is not an issue."""
    return RowCheck(where=lambda: ~F.rlike(F.col(column), F.lit(pattern)), **check)


# --- issue rows ---------------------------------------------------------------------------


def _lookup(spark: SparkSession, tables: Tables | None) -> Callable[[str], DataFrame]:
    if tables is None:
        return spark.table
    return tables if callable(tables) else tables.__getitem__


def _key_counts(df: DataFrame, keys: Sequence[str], count_as: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as))


def issue_rows(spark: SparkSession, check: Check, tables: Tables | None = None) -> DataFrame:
    """The offending rows (or keys) of one check, still distributed."""
    get = _lookup(spark, tables)
    if isinstance(check, RowCheck):
        found = get(check.table).where(_predicate(check))
        return found.select(*check.show) if check.show else found
    if isinstance(check, DuplicateCheck):
        if check.near_unique:
            return repeated_keys(get(check.table), check.keys, check.count_as)
        counts = _key_counts(get(check.table), check.keys, check.count_as)
        return counts.where(F.col(check.count_as) > 1)
    return _issues_by_sql(spark, check, tables) if isinstance(check.issues, str) else check.issues(get)


def _issues_by_sql(spark: SparkSession, check: QueryCheck, tables: Tables | None) -> DataFrame:
    """SQL text reads the catalogue's tables, and the given mapping's under their own names, dotted ones
    included. The session's views are left alone: the text sees the tables as the names of a WITH clause
    over views of unique names, which last while the statement is planned."""
    if tables is None:
        return spark.sql(check.issues)
    if callable(tables):
        raise CheckError(f"check {check.name!r} is SQL text and needs its tables by name")
    views = {name: f"_check_{uuid.uuid4().hex}" for name in tables}
    text = check.issues.strip().rstrip(";")
    dotted = sorted((n for n in tables if "." in n), key=len, reverse=True)
    if dotted:
        names = "|".join(r"\s*\.\s*".join(map(re.escape, n.split("."))) for n in dotted)
        # strings, quoted names and comments stay as they are
        pattern = rf"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/)|(?<![\w.`])({names})(?![\w])"""
        text = re.sub(
            pattern, lambda m: m[1] or "`" + re.sub(r"\s", "", m[2]) + "`", text, flags=re.DOTALL | re.IGNORECASE
        )
    named = ", ".join(f"`{name}` AS (SELECT * FROM {view})" for name, view in views.items())
    try:
        for name, df in tables.items():
            df.createOrReplaceTempView(views[name])
        return spark.sql(f"WITH {named} SELECT * FROM (\n{text}\n)")
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


# --- status -------------------------------------------------------------------------------


def tiered(threshold: float = PASS_THRESHOLD) -> Policy:
    """PASS from `threshold` on; below it critical checks fail, high ones fail under 90,
    medium ones under 85; everything else is a WARNING."""

    def status(issues: Column, clean_pct: Column, severity: Column) -> Column:
        fails = (
            (severity == "critical")
            | ((severity == "high") & (clean_pct < 90.0))
            | ((severity == "medium") & (clean_pct < 85.0))
        )
        return F.when(clean_pct >= threshold, "PASS").when(fails, "FAIL").otherwise("WARNING")

    return status


def strict() -> Policy:
    """PASS only without any issue."""
    return lambda issues, clean_pct, severity: F.when(issues == 0, "PASS").otherwise("FAIL")


def flat(threshold: float = PASS_THRESHOLD) -> Policy:
    """PASS from `threshold` on, else FAIL."""
    return lambda issues, clean_pct, severity: F.when(clean_pct >= threshold, "PASS").otherwise("FAIL")


def two_decimals(x: Column) -> Column:
    """Nearest two-decimal value of the double as it is stored. (`round` would first take its
    shortest decimal form, so 48.595, stored a little lower, would become 48.6.)"""
    return F.call_function("format_number", x, F.lit("0.00")).cast("double")


# --- metrics ------------------------------------------------------------------------------

_COUNTS = "check_pos int, total bigint, issues bigint"


def _count_line(pos: int, total: Column, issues: Column) -> Column:
    return F.struct(
        F.lit(pos).alias("check_pos"), total.cast("bigint").alias("total"), issues.cast("bigint").alias("issues")
    )


def _row_check_counts(
    df: DataFrame, checks: Sequence[tuple[int, RowCheck]], totals: Sequence[int] = ()
) -> DataFrame:
    """Counts of row checks, and of the table for the checks numbered in `totals`, by one scan."""
    counts = [F.count_if(_predicate(c)).alias(f"i{pos}") for pos, c in checks]
    one = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    lines = [_count_line(pos, F.col("total"), F.col(f"i{pos}")) for pos, _ in checks]
    lines += [_count_line(pos, F.col("total"), F.lit(0)) for pos in totals]
    return one.select(F.inline(F.array(*lines)))


def _duplicate_counts(df: DataFrame, pos: int, check: DuplicateCheck, totals: Sequence[int] = ()) -> DataFrame:
    n = F.col("n")
    one = _key_counts(df, check.keys, "n").agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total"), F.count_if(n > 1).alias("issues")
    )
    lines = [_count_line(pos, F.col("total"), F.col("issues"))]
    lines += [_count_line(other, F.col("total"), F.lit(0)) for other in totals]
    return one.select(F.inline(F.array(*lines)))


def _query_counts(issues: DataFrame, pos: int) -> DataFrame:
    one = issues.agg(F.count(F.lit(1)).alias("n"))
    return one.select(F.inline(F.array(_count_line(pos, F.lit(0), F.col("n")))))


def _reason(error: Exception) -> str:
    return str(error).strip().splitlines()[0]


def _branches(
    spark: SparkSession, checks: Sequence[tuple[int, Check]], tables: Tables | None
) -> tuple[list[DataFrame], dict[int, str]]:
    """Count branches of the checks that can be planned, and why the others cannot. A table's rows
    are counted once for all its checks, along with another count if there is one."""
    get = _lookup(spark, tables)
    branches: list[DataFrame] = []
    errors: dict[int, str] = {}
    by_row: dict[str, list[tuple[int, RowCheck]]] = {}
    by_key: dict[str, list[tuple[int, DuplicateCheck]]] = {}
    totals: dict[str, list[int]] = {}
    for pos, check in checks:
        try:
            df = get(check.table)
            if isinstance(check, RowCheck):
                df.select(_predicate(check))  # resolves the predicate, runs nothing
                by_row.setdefault(check.table, []).append((pos, check))
            elif isinstance(check, DuplicateCheck) and not check.near_unique:
                _key_counts(df, check.keys)
                by_key.setdefault(check.table, []).append((pos, check))
            else:
                branches.append(_query_counts(issue_rows(spark, check, tables), pos))
                totals.setdefault(check.table, []).append(pos)
        except Exception as error:  # noqa: BLE001 - one bad check must not stop the others
            errors[pos] = _reason(error)
    for name, group in by_key.items():
        for i, (pos, check) in enumerate(group):
            own = totals.pop(name, ()) if i == 0 and name not in by_row else ()
            branches.append(_duplicate_counts(get(name), pos, check, own))
    for name in dict.fromkeys([*by_row, *totals]):
        branches.append(_row_check_counts(get(name), by_row.get(name, ()), totals.get(name, ())))
    return branches, errors


def _results(
    spark: SparkSession,
    checks: Sequence[tuple[int, Check]],
    counts: DataFrame,
    errors: Mapping[int, str],
    policy: Policy,
) -> DataFrame:
    about = few_rows(
        spark,
        [(p, c.name, c.table, c.severity, c.description, errors.get(p)) for p, c in checks],
        "check_pos int, check_name string, table_name string, severity string, "
        "description string, error string",
    )
    counts = counts.groupBy("check_pos").agg(
        F.sum("total").alias("total_records"), F.sum("issues").alias("issues_found")
    )
    zero = F.lit(0).cast("bigint")
    total, issues = F.col("total_records"), F.col("issues_found")
    clean = total - issues
    failed = F.col("error").isNotNull()
    clean_pct = F.when(total > 0, clean / total * 100).otherwise(0.0)
    issue_pct = F.when(total > 0, issues / total * 100).otherwise(0.0)
    status = F.when(failed, "ERROR").otherwise(policy(issues, clean_pct, F.col("severity")))
    # one line per check on both sides
    joined = F.broadcast(about).join(counts, "check_pos", "left").withColumns(
        {"total_records": F.coalesce(total, zero), "issues_found": F.coalesce(issues, zero)}
    )
    return joined.select(
        "check_pos", "check_name", "table_name", "severity", "description",
        total, issues, clean.alias("clean_records"),
        two_decimals(clean_pct).alias("clean_percentage"),
        two_decimals(issue_pct).alias("issue_percentage"),
        status.alias("status"), "error",
    )


def results_of_counts(
    spark: SparkSession,
    checks: Sequence[tuple[int, Check]],
    counts: Sequence[tuple[int, int, int]],
    policy: Policy | None = None,
) -> DataFrame:
    """One row per numbered check from counts taken elsewhere: (number, rows, issues)."""
    return _results(spark, checks, few_rows(spark, counts, _COUNTS), {}, policy or tiered())


def check_results(
    spark: SparkSession,
    checks: Sequence[Check],
    tables: Tables | None = None,
    policy: Policy | None = None,
) -> DataFrame:
    """One row per check, lazily. A check that cannot be planned becomes an ERROR row."""
    numbered = list(enumerate(checks))
    branches, errors = _branches(spark, numbered, tables)
    counts = reduce(DataFrame.unionByName, branches) if branches else few_rows(spark, [], _COUNTS)
    return _results(spark, numbered, counts, errors, policy or tiered())


def run_checks(
    spark: SparkSession,
    checks: Sequence[Check],
    tables: Tables | None = None,
    policy: Policy | None = None,
) -> DataFrame:
    """Like `check_results`, but run now, so that a check failing while it runs becomes an
    ERROR row too: if the shared job fails, its checks are repeated in halves until those that fail
    stand alone, about log2(n) more jobs for one among n."""
    policy = policy or tiered()
    numbered = list(enumerate(checks))
    planned, errors = _branches(spark, numbered, tables)
    counts: list[tuple] = []
    waiting = [[(pos, c) for pos, c in numbered if pos not in errors]]
    while waiting:
        group = waiting.pop()
        # all together are planned already
        branches = planned if planned is not None else _branches(spark, group, tables)[0]
        planned = None
        if not branches:
            continue
        try:
            counts += [tuple(r) for r in reduce(DataFrame.unionByName, branches).collect()]
        except Exception as error:  # noqa: BLE001
            if len(group) == 1:
                errors[group[0][0]] = _reason(error)
            else:
                half = len(group) // 2
                waiting += [group[half:], group[:half]]
    rows = _results(spark, numbered, few_rows(spark, counts, _COUNTS), errors, policy).collect()
    return few_rows(spark, [tuple(r) for r in rows], RESULT_SCHEMA)


def run_concurrently(
    spark: SparkSession,
    branches: Mapping[str, Sequence[Check]],
    tables: Tables | None = None,
    policy: Policy | None = None,
) -> DataFrame:
    """`run_checks` of independent branches, such as layers, at the same time, a thread and a scheduler pool named
    after it each (the pools share evenly under `spark.scheduler.mode=FAIR`); their rows in one set, numbered
    on from branch to branch. Tables are looked up by one branch at a time, so a lookup that keeps what it
    has planned plans it once."""
    get, lock = _lookup(spark, tables), threading.RLock()

    def looked_up(name: str) -> DataFrame:
        with lock:
            return get(name)

    def run(name: str) -> list[tuple]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        given = looked_up if tables is None or callable(tables) else tables
        # SQL text needs its tables by name, or the catalogue
        if tables is None and any(isinstance(c, QueryCheck) and isinstance(c.issues, str) for c in branches[name]):
            given = None
        return [tuple(r) for r in run_checks(spark, branches[name], given, policy).collect()]

    if not branches:
        return few_rows(spark, [], RESULT_SCHEMA)
    with ThreadPoolExecutor(len(branches)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(run), name) for name in branches]
        rows = [row for each in waiting for row in each.result()]
    return few_rows(spark, [(pos, *row[1:]) for pos, row in enumerate(rows)], RESULT_SCHEMA)


class ObservedChecks:
    """Row checks of a table counted while its rows go by, typically to where they are written: no scan of
    their own. `watch` a DataFrame, run one action on what it returns, then ask for `results`."""

    def __init__(self, checks: Sequence[RowCheck]):
        for check in checks:
            if not isinstance(check, RowCheck):
                raise CheckError(f"check {check.name!r} does not look at single rows")
        self.checks = list(checks)
        self._seen: list[tuple[Observation, list[tuple[int, RowCheck]]]] = []

    def watch(self, df: DataFrame, table: str) -> DataFrame:
        """`df` with the checks of `table` counted on the way."""
        own = [(pos, c) for pos, c in enumerate(self.checks) if c.table == table]
        seen = Observation(f"checks-{uuid.uuid4().hex}")
        self._seen.append((seen, own))
        return df.observe(
            seen, F.count(F.lit(1)).alias("total"), *[F.count_if(_predicate(c)).alias(f"i{pos}") for pos, c in own]
        )

    def results(self, spark: SparkSession, policy: Policy | None = None) -> DataFrame:
        """One row per check, as `check_results` gives it; waits for the watched actions."""
        counts = [
            (pos, seen.get["total"], seen.get[f"i{pos}"]) for seen, own in self._seen for pos, _ in own
        ]
        missed = set(range(len(self.checks))) - {pos for pos, _, _ in counts}
        errors = {pos: f"table {self.checks[pos].table!r} was not watched" for pos in missed}
        return _results(spark, list(enumerate(self.checks)), few_rows(spark, counts, _COUNTS), errors, policy or tiered())


def run_check(
    spark: SparkSession,
    layers: Mapping[str, Sequence[Check]],
    layer: str,
    name: str,
    tables: Tables | None = None,
    policy: Policy | None = None,
) -> DataFrame:
    """One named check of a layer."""
    for check in layer_checks(layers, layer):
        if check.name == name:
            return run_checks(spark, [check], tables, policy)
    raise ValueError(f"no check {name!r} in layer {layer!r}")


def layer_checks(layers: Mapping[str, Sequence[Check]], layer: str) -> Sequence[Check]:
    if layer not in layers:
        raise ValueError(f"unknown layer {layer!r}, expected one of {sorted(layers)}")
    return layers[layer]


def check_names(layers: Mapping[str, Sequence[Check]], layer: str) -> list[str]:
    return [c.name for c in layer_checks(layers, layer)]


# --- summaries over result rows -----------------------------------------------------------


def worst_status(status: Column) -> Column:
    """Aggregate: the worst status present, PASS for no rows."""
    rank = F.array_position(F.array(*[F.lit(s) for s in WORST_FIRST]), status)
    worst = F.min(F.when(rank > 0, rank))
    return F.coalesce(F.element_at(F.array(*[F.lit(s) for s in WORST_FIRST]), worst.cast("int")), F.lit("PASS"))


def layer_summary(results: DataFrame) -> DataFrame:
    """Counts by status and the overall status, one row."""
    status = F.col("status")
    return results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(status == "PASS").alias("passed_checks"),
        F.count_if(status == "FAIL").alias("failed_checks"),
        F.count_if(status == "ERROR").alias("error_checks"),
        worst_status(status).alias("overall_status"),
    )


def restated(results: DataFrame, policy: Policy) -> DataFrame:
    """The same results judged by another policy, from their counts; ERROR rows stay."""
    total, issues = F.col("total_records"), F.col("issues_found")
    clean_pct = F.when(total > 0, (total - issues) / total * 100).otherwise(0.0)
    status = F.when(F.col("error").isNotNull(), "ERROR").otherwise(policy(issues, clean_pct, F.col("severity")))
    return results.withColumn("status", status)


def merge_results(*results: DataFrame) -> DataFrame:
    """Union of result sets; of rows with the same check name the last set wins, at the place
    where the name first appeared. Positions are renumbered from 0."""
    tagged = [r.withColumn("_set", F.lit(i)) for i, r in enumerate(results)]
    rows = reduce(DataFrame.unionByName, tagged)
    place = F.struct("_set", "check_pos")
    whole = F.struct(*[c for c in results[0].columns if c != "check_pos"])
    merged = rows.groupBy("check_name").agg(
        F.max_by(whole, place).alias("row"), F.min(place).alias("place")
    )
    # one line per check name
    pos = F.row_number().over(Window.orderBy("place")) - 1
    merged = merged.select(pos.alias("check_pos"), "row.*")
    return merged.select(*results[0].columns)


def weighted_score(results: DataFrame, weights: Mapping[str, float] = SEVERITY_WEIGHTS) -> DataFrame:
    """Clean percentage averaged with the severity weights, one row."""
    weight = None
    for severity, w in weights.items():
        weight = (F if weight is None else weight).when(F.col("severity") == severity, w)
    weight = weight.otherwise(0.0)
    score = F.sum(weight * F.col("clean_percentage")) / F.nullif(F.sum(weight), F.lit(0.0))
    return results.agg(F.round(score, 4).alias("weighted_score"))


def alerts(results: DataFrame) -> DataFrame:
    """A message per failed check."""
    text = F.concat(
        F.lit("check "), "check_name", F.lit(" on "), "table_name", F.lit(": "), "status",
        F.lit(", "), F.col("issues_found").cast("string"), F.lit(" of "),
        F.col("total_records").cast("string"), F.lit(" rows"),
        F.coalesce(F.concat(F.lit(", "), F.col("error")), F.lit("")),
    )
    failed = results.where(F.col("status").isin("FAIL", "ERROR"))
    return failed.select("check_pos", "check_name", "table_name", "severity", "status", text.alias("message"))
