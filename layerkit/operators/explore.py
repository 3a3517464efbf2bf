"""Explorative profile of a table: how its columns hang together, how values are spread, repeated rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.session import store

CORRELATIONS = "first string, second string, correlation double, n bigint"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _name(column: str):
    return F.col("`" + column.replace("`", "``") + "`")


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(first, second, correlation, n): Pearson's coefficient of every pair of numeric columns over the `n` rows that have
    both, from the co-moments of all pairs in one pass; null if either does not vary there."""
    names = list(columns or numeric_columns(df))
    pairs = list(combinations(names, 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], CORRELATIONS)
    aggs = []
    for i, (a, b) in enumerate(pairs):
        x, y = _name(a).cast("double"), _name(b).cast("double")
        both = x.isNotNull() & y.isNotNull()
        varies = (F.min(F.when(both, x)) < F.max(F.when(both, x))) & (F.min(F.when(both, y)) < F.max(F.when(both, y)))
        spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
        aggs += [F.when(varies, F.try_divide(F.covar_pop(x, y), spread)).alias(f"c{i}"), F.count_if(both).alias(f"n{i}")]
    lines = [
        F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"c{i}").alias("correlation"), F.col(f"n{i}").alias("n"))
        for i, (a, b) in enumerate(pairs)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*lines)))


def ranks(df: DataFrame, column: str) -> DataFrame:
    """(value, rank): the average rank of each distinct value of a column among those that are not null, from 1.

    Values are counted, sorted by range partitions, and stored with their partition; what lies in earlier
    partitions comes from one line per partition, so no task sees more than its own range.
    """
    counts = df.where(_name(column).isNotNull()).groupBy(_name(column).alias("value")).agg(F.count("*").alias("n"))
    ordered = counts.orderBy("value").withColumn("at", F.monotonically_increasing_id())
    ordered = store(ordered, "ranks").withColumn("part", F.shiftright("at", 33))
    sizes = ordered.groupBy("part").agg(F.sum("n").alias("n"))
    # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = ordered.withColumn("earlier", F.coalesce(F.sum("n").over(within), F.lit(0))).join(sizes, "part")
    return placed.select("value", (F.col("before") + F.col("earlier") + (F.col("n") + 1) / 2).alias("rank"))


def rank_correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Spearman's coefficient of every pair of numeric columns: `correlations` of their ranks, each among its own column's
    values, equal values sharing the average. One join per column, on distinct values."""
    names = list(columns or numeric_columns(df))
    rows = df.select(*[_name(c) for c in names])
    for i, c in enumerate(names):
        place = ranks(df, c).select(F.col("value").alias(f"_v{i}"), F.col("rank").alias(f"_r{i}"))
        rows = rows.join(place, _name(c) == F.col(f"_v{i}"), "left").drop(f"_v{i}")
    return correlations(rows.select(*[F.col(f"_r{i}").alias(c) for i, c in enumerate(names)]), names)


def associations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(first, second, cramers_v, n): Cramér's V of every pair of text columns over the rows that have both; null if
    either has one value there. Only counted combinations move, after counting them where they are."""
    names = list(columns or text_columns(df))
    pairs = [
        F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), _name(a).alias("a"), _name(b).alias("b"))
        for a, b in combinations(names, 2)
    ]
    if not pairs:
        return df.sparkSession.createDataFrame([], "first string, second string, cramers_v double, n bigint")
    each = df.select(F.inline(F.array(*pairs))).where("a IS NOT NULL AND b IS NOT NULL")
    cells = store(each.groupBy("first", "second", "a", "b").agg(F.count("*").alias("cell")), "cells")
    key = ["first", "second"]
    sides = [cells.groupBy(*key, s).agg(F.sum("cell").alias(f"of_{s}")) for s in ("a", "b")]
    joined = cells.join(sides[0], [*key, "a"]).join(sides[1], [*key, "b"])
    share = F.sum(F.col("cell") * F.col("cell") / (F.col("of_a").cast("double") * F.col("of_b")))
    sums = joined.groupBy(*key).agg(share.alias("share"), F.sum("cell").alias("n"))
    kinds = [s.groupBy(*key).agg(F.count("*").alias(f"n_{c}")) for s, c in zip(sides, "ab")]
    least = F.least("n_a", "n_b") - 1
    v = F.when(least > 0, F.sqrt(F.greatest(F.col("share") - 1, F.lit(0.0)) / least))
    return reduce(lambda x, y: x.join(y, key), [sums, *kinds]).select(*key, v.alias("cramers_v"), "n")


def histograms(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """(column_name, bin, lower, upper, n): rows in each of `bins` equal ranges between the least and the greatest value of a
    numeric column, bins without rows included; a value on an edge belongs to the upper bin, the greatest to the last. Nulls and NaN
    are not counted. A column of one value has one bin, one without values none. Two passes over all columns together."""
    names = list(columns or numeric_columns(df))
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, bin int, lower double, upper double, n bigint")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.nullif(_name(c).cast("double"), F.lit(float("nan"))).alias("value")) for c in names])
    values = df.select(F.inline(cells)).where("value IS NOT NULL")
    # a row per column
    ends = values.groupBy("column_name").agg(F.min("value").alias("least"), F.max("value").alias("most"))
    ends = F.broadcast(store(ends, "ends"))
    width = (F.col("most") - F.col("least")) / bins
    place = F.when(F.col("most") == F.col("least"), 0).otherwise(
        F.least(F.floor((F.col("value") - F.col("least")) / width), F.lit(bins - 1))
    )
    counted = values.join(ends, "column_name").groupBy("column_name", place.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    last = F.when(F.col("most") > F.col("least"), bins - 1).otherwise(0)
    every = ends.select("*", F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    filled = every.join(counted, ["column_name", "bin"], "left")
    return filled.select(
        "column_name", "bin", (F.col("least") + F.col("bin") * width).alias("lower"),
        F.when(F.col("bin") == last, F.col("most")).otherwise(F.col("least") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def repeated_rows(df: DataFrame, count_as: str = "copies") -> DataFrame:
    """Rows that occur more than once, each once with the number of its copies. Hashes of rows are counted first, so
    only rows whose hash repeats are moved and compared as a whole."""
    if count_as in df.columns:
        raise ValueError(f"the rows already have a column {count_as!r}")
    parts = [p for c in df.columns for p in (_name(c).isNull(), _name(c))]
    marked = df.select("*", F.xxhash64(*parts).alias("_mark"))
    twice = marked.groupBy("_mark").agg(F.count("*").alias("_n")).where("_n > 1").select("_mark")
    some = marked.join(twice, "_mark", "left_semi")
    counts = some.groupBy(*[_name(c) for c in df.columns]).agg(F.count("*").alias(count_as))
    return counts.where(F.col(count_as) > 1)
