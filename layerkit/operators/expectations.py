"""Declarative expectation suites, compiled into one aggregate per table plus one grouped
count per unique column."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_COUNT = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
OF_TYPE = "expect_column_values_to_be_of_type"
BETWEEN = "expect_column_values_to_be_between"

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMERIC = (*INTEGRAL, T.FloatType, T.DoubleType, T.DecimalType)
EXACT_TYPES = {"INTEGER": (T.IntegerType,), "FLOAT": (T.FloatType, T.DoubleType), "DATE": (T.DateType,)}
TYPE_FAMILIES = {"INTEGER": INTEGRAL, "FLOAT": NUMERIC, "DATE": (T.DateType,)}


@dataclass(frozen=True)
class Expectation:
    type: str
    kwargs: Mapping[str, Any] = field(default_factory=dict)

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")


@dataclass(frozen=True)
class Suite:
    name: str
    expectations: Sequence[Expectation]


def row_count_between(min_value: int | None = None, max_value: int | None = None) -> Expectation:
    return Expectation(ROW_COUNT, {"min_value": min_value, "max_value": max_value})


def not_null(column: str) -> Expectation:
    return Expectation(NOT_NULL, {"column": column})


def unique(column: str) -> Expectation:
    return Expectation(UNIQUE, {"column": column})


def in_set(column: str, value_set: Sequence) -> Expectation:
    return Expectation(IN_SET, {"column": column, "value_set": list(value_set)})


def of_type(column: str, type_: str) -> Expectation:
    return Expectation(OF_TYPE, {"column": column, "type_": type_})


def between(column: str, min_value=None, max_value=None) -> Expectation:
    return Expectation(BETWEEN, {"column": column, "min_value": min_value, "max_value": max_value})


def load_suite(path: str) -> Suite:
    """Suite from a JSON file with `expectation_suite_name` and a list of `expectations`,
    each an `expectation_type` with `kwargs`."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    items = [Expectation(e["expectation_type"], e["kwargs"]) for e in spec["expectations"]]
    return Suite(spec["expectation_suite_name"], items)


def _in_range(value: Column, kwargs: Mapping[str, Any]) -> Column:
    ok = F.lit(True)
    if kwargs.get("min_value") is not None:
        ok = ok & (value >= F.lit(kwargs["min_value"]))
    if kwargs.get("max_value") is not None:
        ok = ok & (value <= F.lit(kwargs["max_value"]))
    return ok


def _type_matches(data_type: T.DataType, type_: str, families: bool) -> bool:
    wanted = (TYPE_FAMILIES if families else EXACT_TYPES).get(type_.upper())
    if wanted is None:
        raise ValueError(f"unknown type {type_!r}")
    return isinstance(data_type, wanted)


def _unexpected(e: Expectation) -> Column | None:
    """Predicate counting unexpected rows, for the types that need nothing but the row."""
    if e.type == NOT_NULL:
        return F.col(e.column).isNull()
    if e.type == IN_SET:
        return F.col(e.column).isNotNull() & ~F.col(e.column).isin([v for v in e.kwargs["value_set"] if v is not None])
    if e.type == BETWEEN:
        return F.col(e.column).isNotNull() & ~_in_range(F.col(e.column), e.kwargs)
    return None


def _line(suite, pos, e, success, elements, absent, unexpected, observed, message) -> Column:
    elements = elements.cast("bigint")
    absent, unexpected = absent.cast("bigint"), unexpected.cast("bigint")
    base = elements - F.coalesce(absent, F.lit(0))
    percent = F.when(unexpected.isNull(), None).when(base > 0, unexpected / base * 100).otherwise(0.0)
    return F.struct(
        F.lit(suite).alias("suite"),
        F.lit(pos).alias("expectation_pos"),
        F.lit(e.type).alias("expectation"),
        F.lit(e.column).cast("string").alias("column_name"),
        success.alias("success"),
        elements.alias("element_count"),
        absent.alias("missing_count"),
        unexpected.alias("unexpected_count"),
        percent.cast("double").alias("unexpected_percent"),
        observed.cast("string").alias("observed"),
        message.cast("string").alias("message"),
    )


def _shared_lines(df: DataFrame, suite: Suite, items, families: bool) -> DataFrame:
    nothing = F.lit(None)
    columns = {f.name: f.dataType for f in df.schema.fields}
    aggs = {"n": F.count(F.lit(1))}
    lines = []
    for pos, e in items:
        n = F.col("n")
        if e.column is not None and e.column not in columns:
            text = F.lit(f"column {e.column} does not exist")
            lines.append(_line(suite.name, pos, e, F.lit(False), n, nothing, nothing, nothing, text))
        elif e.type == ROW_COUNT:
            lines.append(_line(suite.name, pos, e, _in_range(n, e.kwargs), n, nothing, nothing, n, nothing))
        elif e.type == OF_TYPE:
            ok = F.lit(_type_matches(columns[e.column], e.kwargs["type_"], families))
            seen = F.lit(columns[e.column].simpleString())
            lines.append(_line(suite.name, pos, e, ok, n, nothing, nothing, seen, nothing))
        else:
            predicate = _unexpected(e)
            if predicate is None:
                raise ValueError(f"unknown expectation {e.type!r}")
            aggs[f"u{pos}"] = F.count_if(predicate)
            absent = F.lit(0)
            if e.type != NOT_NULL:
                aggs[f"m{pos}"] = F.count_if(F.col(e.column).isNull())
                absent = F.col(f"m{pos}")
            bad = F.col(f"u{pos}")
            lines.append(_line(suite.name, pos, e, bad == 0, n, absent, bad, nothing, nothing))
    one = df.agg(*[a.alias(name) for name, a in aggs.items()])
    return one.select(F.inline(F.array(*lines)))


def _unique_line(df: DataFrame, suite: Suite, pos: int, e: Expectation) -> DataFrame:
    value, n = F.col(e.column), F.col("_n")
    one = df.groupBy(e.column).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("m"),
        F.coalesce(F.sum(F.when(value.isNotNull() & (n > 1), n)), F.lit(0)).alias("u"),
    )
    nothing = F.lit(None)
    line = _line(suite.name, pos, e, F.col("u") == 0, F.col("n"), F.col("m"), F.col("u"), nothing, nothing)
    return one.select(F.inline(F.array(line)))


def validate(df: DataFrame, suite: Suite, families: bool = False) -> DataFrame:
    """One row per expectation. NULLs count as unexpected only for not-null; every row of a
    repeated value is unexpected for unique; a missing column is a failed row. With
    `families`, INTEGER accepts any integral and FLOAT any numeric type."""
    columns = set(df.columns)
    grouped, shared = [], []
    for pos, e in enumerate(suite.expectations):
        (grouped if e.type == UNIQUE and e.column in columns else shared).append((pos, e))
    parts = [_shared_lines(df, suite, shared, families)] if shared else []
    parts += [_unique_line(df, suite, pos, e) for pos, e in grouped]
    if not parts:
        raise ValueError(f"suite {suite.name!r} is empty")
    return reduce(DataFrame.unionByName, parts)


def run_checkpoint(
    layer: str,
    batches: Sequence[tuple[DataFrame, Suite]],
    path: str | None = None,
    started: dt.datetime | None = None,
    families: bool = False,
) -> DataFrame:
    """Validate every (table, suite) pair of a layer. With `path`, the result rows are stored
    as JSON under the run name and returned from there."""
    run = f"{started or dt.datetime.now():%Y%m%d-%H%M%S}-{layer}-quality-check"
    results = reduce(DataFrame.unionByName, [validate(df, s, families) for df, s in batches])
    results = results.withColumn("run_name", F.lit(run))
    if path is None:
        return results
    results.write.mode("overwrite").json(f"{path}/{run}", ignoreNullFields=False)
    return results.sparkSession.read.schema(results.schema).json(f"{path}/{run}")
