"""Schema contracts: column types, NULLs, uniqueness and allowed values of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.session import few_rows

OUTCOME_SCHEMA = "contract string, status string, message string"


class ContractError(Exception):
    """Raised by `enforce` when a table breaks its contract."""


@dataclass(frozen=True)
class Field:
    """`types` are the accepted Spark type names, e.g. ("int", "bigint")."""

    types: Sequence[str]
    nullable: bool = True
    unique: bool = False
    isin: Sequence[str] | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    fields: Mapping[str, Field]


def _line(contract: Contract, column: str, rule: str, failures: Column) -> Column:
    failures = failures.cast("bigint")
    return F.struct(
        F.lit(contract.name).alias("contract"),
        F.lit(column).alias("column_name"),
        F.lit(rule).alias("rule"),
        failures.alias("failures"),
        F.when(failures == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per rule of the contract. Columns the contract does not name are allowed. A
    missing column or wrong type counts as one failure; its other rules are left out."""
    present = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs, lines, keyed = [F.count(F.lit(1)).alias("_rows")], [], []
    for name, field in contract.fields.items():
        fits = present.get(name) in field.types
        lines.append(_line(contract, name, "type", F.lit(0 if fits else 1)))
        if not fits:
            continue
        value = F.col(name)
        if not field.nullable:
            aggs.append(F.count_if(value.isNull()).alias(f"_null_{name}"))
            lines.append(_line(contract, name, "not_null", F.col(f"_null_{name}")))
        if field.isin is not None:
            known = [v for v in field.isin if v is not None]
            aggs.append(F.count_if(value.isNotNull() & ~value.isin(known)).alias(f"_isin_{name}"))
            lines.append(_line(contract, name, "isin", F.col(f"_isin_{name}")))
        if field.unique:
            keyed.append(name)
    parts = [df.agg(*aggs).select(F.inline(F.array(*lines)))]
    for name in keyed:
        n = F.col("_n")
        repeats = F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0))
        counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
        one = counts.agg(repeats.alias("_repeats"))
        parts.append(one.select(F.inline(F.array(_line(contract, name, "unique", F.col("_repeats"))))))
    return reduce(DataFrame.unionByName, parts)


def outcome(rules: DataFrame) -> DataFrame:
    """Per contract one `status` and a `message` listing the broken rules."""
    broken = F.when(
        F.col("status") == "FAIL",
        F.concat("column_name", F.lit(" "), "rule", F.lit(": "), F.col("failures").cast("string")),
    )
    # one line per rule of the contract
    listed = F.array_join(F.array_sort(F.collect_list(broken)), "; ")
    status = F.when(F.count_if(F.col("status") == "FAIL") == 0, "PASS").otherwise("FAIL")
    return (
        rules.groupBy("contract")
        .agg(status.alias("status"), listed.alias("listed"))
        .select(
            "contract",
            "status",
            F.when(F.col("status") == "PASS", "Validation successful").otherwise(F.col("listed")).alias("message"),
        )
    )


def enforce(df: DataFrame, contract: Contract, path: str | None = None, strict: bool = True) -> DataFrame:
    """Run the contract now, store its outcome as JSON below `path` and, if `strict`, raise
    `ContractError` when it is broken."""
    result = outcome(check_contract(df, contract))
    done = few_rows(df.sparkSession, [tuple(r) for r in result.collect()], OUTCOME_SCHEMA)
    if path is not None:
        done.coalesce(1).write.mode("overwrite").json(path)
    row = done.first()
    if strict and row.status == "FAIL":
        raise ContractError(f"{row.contract}: {row.message}")
    return done
