"""Column profiles of whole tables as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.operators.quantiles import ACCURACY, exact_quantiles
from layerkit.session import few_rows, store

QUANTILES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}
_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.NumericType):
        return "numeric"
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    if isinstance(t, T.StringType):
        return "text"
    return "boolean" if isinstance(t, T.BooleanType) else "other"


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _cell(df: DataFrame, column: str, shorten: bool) -> Column:
    """A value in the slot of its type, so that numbers are grouped as numbers."""
    t, value = df.schema[column].dataType, F.col(column)
    whole = value if isinstance(t, T.IntegralType) else F.lit(None)
    real = value if isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) else F.lit(None)
    text = F.lit(None)
    if not isinstance(t, T.NumericType) or isinstance(t, T.DecimalType):
        text = (value if isinstance(t, T.AtomicType) else F.to_json(column)).cast("string")
        if isinstance(t, T.TimestampType):  # local time alone would make two instants one
            text = F.date_format(value, _INSTANT)
        if shorten and isinstance(t, T.StringType):
            text = F.sha2(text, 256)
    return F.struct(
        F.lit(column).alias("column_name"),
        whole.cast("bigint").alias("whole"),
        real.cast("double").alias("real"),
        text.cast("string").alias("text"),
    )


def value_counts(df: DataFrame, columns: Sequence[str], shorten: bool = False) -> DataFrame:
    """(column_name, whole, real, text, n) for every non-NULL value, in one scan with map-side
    counting. With `shorten`, texts are replaced by their digests, which keeps them apart without
    shuffling whole texts."""
    return _counted(_cells(df, columns, shorten))


def _cells(df: DataFrame, columns: Sequence[str], shorten: bool = False) -> DataFrame:
    cells = df.select(F.inline(F.array(*[_cell(df, c, shorten) for c in columns])))
    return cells.where("whole is not null or real is not null or text is not null")


def _counted(cells: DataFrame) -> DataFrame:
    return cells.groupBy("column_name", "whole", "real", "text").agg(F.count(F.lit(1)).alias("n"))


def _distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    n = F.col("n")
    return value_counts(df, columns, shorten=True).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_distinct"), F.count_if(n == 1).alias("n_once")
    )


def _per_column(
    df: DataFrame, columns: Sequence[str], measures: Mapping[str, Mapping[str, Column]], exact: bool
) -> DataFrame:
    """One aggregate over the table turned into a row per column, with distinct counts."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        aggs.append(F.count(c).alias(f"count_{i}"))
        if not exact:
            aggs.append(F.approx_count_distinct(c).alias(f"distinct_{i}"))
        aggs += [m.alias(f"{name}_{i}") for name, m in measures[c].items()]
    lines = []
    for i, c in enumerate(columns):
        count = F.col(f"count_{i}")
        line = [
            F.lit(c).alias("column_name"),
            F.lit(_kind(df.schema[c].dataType)).alias("kind"),
            F.col("rows").alias("n"),
            (F.col("rows") - count).alias("n_missing"),
            _ratio(F.col("rows") - count, F.col("rows")).alias("p_missing"),
        ]
        if not exact:
            line.append(F.col(f"distinct_{i}").alias("n_distinct"))
        line += [F.col(f"{name}_{i}").alias(name) for name in measures[c]]
        lines.append(F.struct(*line))
    stats = df.agg(*aggs).select(F.inline(F.array(*lines)))
    present = F.col("n") - F.col("n_missing")
    if exact:
        # one line per column on both sides
        stats = stats.join(F.broadcast(_distinct(df, columns)), "column_name", "left")
        once = F.coalesce("n_once", F.lit(0))
        unique = ((once == present) & (present > 0)).alias("is_unique")
    else:
        unique = F.lit(None).cast("boolean").alias("is_unique")
    distinct = F.coalesce("n_distinct", F.lit(0)).cast("bigint")
    return stats.select(
        "column_name", "kind", "n", "n_missing", "p_missing",
        distinct.alias("n_distinct"), _ratio(distinct, present).alias("p_distinct"), unique,
        *measures[columns[0]],
    )


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Kind, missing and distinct counts of every column. `exact=False` counts distinct values
    with a sketch and leaves `is_unique` NULL."""
    columns = list(columns or df.columns)
    return _per_column(df, columns, {c: {} for c in columns}, exact)


def _quantile_columns(df: DataFrame, columns: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    found = exact_quantiles(df, columns, list(quantiles.values()))
    rows = [(c, *[found[c][p] for p in quantiles.values()]) for c in columns]
    schema = "column_name string, " + ", ".join(f"{q} double" for q in quantiles)
    return few_rows(df.sparkSession, rows, schema)


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Moments, range, quantiles, zeros and negatives of the numeric columns."""
    columns = list(columns or numeric_columns(df))
    if not columns:
        raise ValueError("no numeric columns to profile")
    measures = {}
    for c in columns:
        x = F.col(c).cast("double")
        measures[c] = {
            "min": F.min(x), "max": F.max(x), "mean": F.avg(x), "std": F.stddev_samp(x),
            "n_zeros": F.count_if(x == 0), "n_negative": F.count_if(x < 0),
        }
        if not exact:
            measures[c]["sketch"] = F.percentile_approx(x, list(QUANTILES.values()), ACCURACY)
    stats = _per_column(df, columns, measures, exact)
    if not exact:
        stats = stats.withColumns({q: F.col("sketch")[i] for i, q in enumerate(QUANTILES)}).drop("sketch")
    else:
        values = _quantile_columns(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns, QUANTILES)
        stats = stats.join(F.broadcast(values), "column_name")
    return stats.select(
        "*",
        (F.col("max") - F.col("min")).alias("range"),
        (F.col("q75") - F.col("q25")).alias("iqr"),
        _ratio(F.col("n_zeros"), F.col("n")).alias("p_zeros"),
        _ratio(F.col("n_negative"), F.col("n")).alias("p_negative"),
    )


def profile_string(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Lengths and extremes of the string columns."""
    columns = list(columns or string_columns(df))
    if not columns:
        raise ValueError("no string columns to profile")
    measures = {}
    for c in columns:
        length = F.length(c)
        measures[c] = {
            "min_length": F.min(length), "max_length": F.max(length), "mean_length": F.avg(length),
            "n_empty": F.count_if(length == 0),
        }
        if not exact:
            measures[c]["median_length"] = F.percentile_approx(length, 0.5, ACCURACY).cast("double")
    stats = _per_column(df, columns, measures, exact)
    if exact:
        lengths = df.select(*[F.length(c).alias(c) for c in columns])
        medians = _quantile_columns(lengths, columns, {"median_length": 0.5})
        stats = stats.join(F.broadcast(medians), "column_name")
    return stats


def profile_dates(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """First and last value of the date and timestamp columns, and the days between them."""
    columns = list(columns or [f.name for f in df.schema.fields if _kind(f.dataType) == "date"])
    if not columns:
        raise ValueError("no date columns to profile")
    measures = {}
    for c in columns:
        at = F.col(c).cast("timestamp_ntz")
        measures[c] = {"min": F.min(at), "max": F.max(at)}
    stats = _per_column(df, columns, measures, exact)
    days = F.datediff(F.col("max").cast("date"), F.col("min").cast("date"))
    return stats.withColumn("range_days", days)


def profile_top_values(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The k most frequent values per column, ties by value. The best k of each of many parts of a
    column's values are found first, so no task ranks all of them."""
    return _top(value_counts(df, columns), k)


def _top(counts: DataFrame, k: int) -> DataFrame:
    best = [F.col("n").desc(), F.col("value").asc()]
    order = Window.partitionBy("column_name").orderBy(*best)
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    within = Window.partitionBy("column_name", "part").orderBy(*best)
    value = F.coalesce(F.col("whole").cast("string"), F.col("real").cast("string"), "text")
    counts = counts.select("column_name", value.alias("value"), "n")
    counts = counts.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(parts)))
    counts = counts.withColumn("place", F.row_number().over(within)).where(F.col("place") <= k)
    ranked = counts.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("column_name", "rank", "value", "n")


def profile_top_values_bounded(df: DataFrame, columns: Sequence[str], k: int = 10, buckets: int = 4096) -> DataFrame:
    """`profile_top_values` without a group for every distinct value.

    A first pass counts two independent hash buckets of every value: `buckets` counters a column and hash,
    whatever the number of values, pre-aggregated and written out. The values of the 2k fullest buckets are
    counted next; the k-th of them bounds the k-th of all from below. A value can be among the best only if both of
    its buckets reach that bound, so only such values are counted for the result, which is exact. Of a
    column whose values are all about as frequent, most reach it.
    """
    cells = _cells(df, columns)
    for depth in (0, 1):
        slot = F.xxhash64(F.lit(depth), "column_name", "whole", "real", "text")
        cells = cells.withColumn(f"bucket_{depth}", F.pmod(slot, F.lit(buckets)).cast("int"))
    both = F.array(*[F.struct(F.lit(d).alias("depth"), F.col(f"bucket_{d}").alias("bucket")) for d in (0, 1)])
    counters = cells.select("column_name", F.inline(both)).groupBy("column_name", "depth", "bucket")
    counters = store(counters.agg(F.count(F.lit(1)).alias("in_bucket")), "buckets")
    fullest = Window.partitionBy("column_name").orderBy(F.desc("in_bucket"), "bucket")
    first = counters.where("depth = 0").withColumn("place", F.row_number().over(fullest)).where(F.col("place") <= 2 * k)
    # counters are at most `buckets` a column and hash
    likely = cells.join(F.broadcast(_named(first, 0)), ["column_name", "bucket_0"], "left_semi")
    least = _top(_counted(likely), k).where(F.col("rank") == k).select("column_name", F.col("n").alias("least"))
    reaching = counters.join(F.broadcast(least), "column_name", "left")
    reaching = reaching.where(F.col("in_bucket") >= F.coalesce("least", F.lit(0)))
    for depth in (0, 1):
        at = _named(reaching.where(F.col("depth") == depth), depth)
        cells = cells.join(F.broadcast(at), ["column_name", f"bucket_{depth}"], "left_semi")
    return _top(_counted(cells), k)


def _named(counters: DataFrame, depth: int) -> DataFrame:
    return counters.select("column_name", F.col("bucket").alias(f"bucket_{depth}"))


def profile_overview(df: DataFrame) -> DataFrame:
    """Size and missing cells of a table, one row."""
    columns = df.columns
    missing = [F.col(f"m{i}") for i in range(len(columns))]
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    cells = reduce(lambda a, b: a + b, missing)
    kinds = [_kind(f.dataType) for f in df.schema.fields]

    def number(flags) -> Column:
        return reduce(lambda a, b: a + b, [F.when(f, 1).otherwise(0) for f in flags]).cast("bigint")

    return one.select(
        "n",
        F.lit(len(columns)).cast("bigint").alias("n_var"),
        cells.alias("n_cells_missing"),
        _ratio(cells, F.col("n") * len(columns)).alias("p_cells_missing"),
        number([m > 0 for m in missing]).alias("n_vars_with_missing"),
        number([(F.col("n") > 0) & (m == F.col("n")) for m in missing]).alias("n_vars_all_missing"),
        *[F.lit(kinds.count(k)).cast("bigint").alias(f"n_{k}") for k in ("numeric", "date", "text", "boolean", "other")],
    )


def profile_layer(tables: Mapping[str, DataFrame], exact: bool = True) -> DataFrame:
    """`profile_columns` of several tables, with the table's name."""
    parts = [
        profile_columns(df, exact=exact).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
