"""Column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerkit.operators import explore as X
from layerkit.operators import profile as P
from layerkit.operators import summaries as S
from layerkit.plans.queries.data import table
from layerkit.plans.queries.quality import labelled_documents
from layerkit.session import new_path

NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
TEXTS = ("text", "lang", "source")
CODES = ("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity")
TABLES = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
}
KINDS = {"c_name": "text", "c_mktsegment": "text", "o_orderstatus": "text", "o_orderpriority": "text",
         "event_type": "text", "props": "text", "o_orderdate": "date", "ts": "date"}
TOP = 5


def _rounded(df):
    doubles = {f.name for f in df.schema.fields if f.dataType.simpleString() == "double"}
    return df.select(*[F.round(c, 7).alias(c) if c in doubles else F.col(c) for c in df.columns])


def numeric_nan(spark, sf):
    """Quantiles of prices, of which those of returned lines are NaN."""
    lines = table(spark, sf, "lineitem")
    price = F.when(F.col("l_returnflag") == "R", F.lit(float("nan"))).otherwise(F.col("l_extendedprice"))
    row = P.profile_numeric(lines.select(price.alias("price")), ["price"])
    return _rounded(row.select("column_name", "n", *P.QUANTILES))


def approximate(spark, sf):
    """Whether sketched distinct counts are within a tenth of the exact ones."""
    tables = {t: table(spark, sf, t) for t in TABLES}
    exact = P.profile_layer(tables).select("table_name", "column_name", "n", "n_missing", "n_distinct")
    near = P.profile_layer(tables, exact=False).select(
        F.col("table_name").alias("t"), F.col("column_name").alias("c"), F.col("n_distinct").alias("sketched")
    )
    # one line per column on both sides
    both = exact.join(near, (F.col("table_name") == F.col("t")) & (F.col("column_name") == F.col("c")))
    close = F.abs(F.col("sketched") - F.col("n_distinct")) <= F.greatest(F.lit(1.0), 0.1 * F.col("n_distinct"))
    return both.select("table_name", "column_name", "n", "n_missing", close.alias("is_close"))


RANKED = ("value", "user_id", "event_id")


def correlated(spark, sf):
    """Pearson's coefficients of the line items' numbers."""
    return _rounded(X.correlations(table(spark, sf, "lineitem"), NUMBERS))


def ranked(spark, sf):
    """Spearman's coefficients of the events' numbers; values that are missing or repeated share ranks."""
    events = table(spark, sf, "events")
    return _rounded(X.rank_correlations(events.withColumn("value", F.floor("value").cast("double")), RANKED))


def associated(spark, sf):
    """Association of the orders' codes with each other."""
    orders = table(spark, sf, "orders")
    month = F.date_format("o_orderdate", "MM").alias("month")
    return _rounded(X.associations(orders.select("o_orderstatus", "o_orderpriority", month)))


def spread(spark, sf):
    return _rounded(X.histograms(table(spark, sf, "lineitem"), NUMBERS, 8))


def repeated(spark, sf):
    """Documents of the same text, language and source."""
    return X.repeated_rows(table(spark, sf, "documents").select("text", "lang", "source"))


SUMMARISED = ("o_totalprice", "o_custkey", "o_orderstatus", "o_orderpriority")


def over_loads(spark, sf):
    """The orders' profile merged from kept summaries of each year, and whether its sketches are as near to
    the exact figures as they promise."""
    orders = table(spark, sf, "orders")
    path = new_path(spark, "summaries")
    S.keep(S.summarise(orders, SUMMARISED, "orders", F.year("o_orderdate")), path)
    near = S.merged(S.kept(spark, path))
    exact = P.profile_columns(orders, SUMMARISED).select("column_name", F.col("n_distinct").alias("exactly"))
    # one line per column on both sides
    near = near.join(F.broadcast(exact), "column_name").withColumn(
        "distinct_close", F.abs(F.col("n_distinct") - F.col("exactly")) <= S.DISTINCT_ERROR * F.col("exactly")
    )
    numbers = [c for c in SUMMARISED if c in P.numeric_columns(orders)]
    cells = orders.select(F.inline(F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in numbers]
    )))
    placed = cells.join(F.broadcast(near.select("column_name", "q50")), "column_name").groupBy("column_name").agg(
        (F.count_if(F.col("x") < F.col("q50")) / F.count("x")).alias("below"),
        (F.count_if(F.col("x") <= F.col("q50")) / F.count("x")).alias("upto"),
    )
    near = near.join(F.broadcast(placed), "column_name", "left")
    close = (F.col("below") <= 0.5 + S.RANK_ERROR) & (F.col("upto") >= 0.5 - S.RANK_ERROR)
    return _rounded(near.select(
        "table_name", "column_name", "loads", "n", "n_missing", "min", "max", "mean", "distinct_close",
        close.alias("median_close"),
    ))


QUERIES = {
    "profile_merged": over_loads,
    "profile_top_values_bounded": lambda spark, sf: P.profile_top_values_bounded(table(spark, sf, "lineitem"), CODES, TOP),
    "profile_correlations": correlated,
    "profile_rank_correlations": ranked,
    "profile_associations": associated,
    "profile_histogram": spread,
    "profile_repeated_rows": repeated,
    "profile_numeric": lambda spark, sf: _rounded(P.profile_numeric(table(spark, sf, "lineitem"), NUMBERS)),
    "profile_string": lambda spark, sf: _rounded(P.profile_string(table(spark, sf, "documents"), TEXTS)),
    "profile_dates": lambda spark, sf: _rounded(P.profile_dates(table(spark, sf, "orders"))),
    "profile_top_values": lambda spark, sf: P.profile_top_values(table(spark, sf, "lineitem"), CODES, TOP),
    "profile_table": lambda spark, sf: _rounded(P.profile_layer({t: table(spark, sf, t) for t in TABLES})),
    "profile_numeric_nan": lambda spark, sf: numeric_nan(spark, sf),
    "profile_table_approx": lambda spark, sf: approximate(spark, sf),
    "profile_overview": lambda spark, sf: _rounded(P.profile_overview(labelled_documents(spark, sf))),
}


def _common_sql(column, kind):
    return f"""'{column}' AS column_name, '{kind}' AS kind, count(*) AS n, count(*) - count({column}) AS n_missing,
        round((count(*) - count({column})) / count(*), 7) AS p_missing,
        count(DISTINCT {column}) AS n_distinct, round(count(DISTINCT {column}) / count({column}), 7) AS p_distinct,
        count(DISTINCT {column}) = count({column}) AND count({column}) > 0 AS is_unique"""


def _numeric_sql(c):
    x = f"CAST({c} AS DOUBLE)"
    quantiles = ", ".join(f"round(quantile_cont({x}, {p}), 7) AS {q}" for q, p in P.QUANTILES.items())
    return f"""SELECT {_common_sql(c, 'numeric')},
        round(min({x}), 7) AS min, round(max({x}), 7) AS max, round(avg({x}), 7) AS mean,
        round(stddev_samp({x}), 7) AS std,
        count(CASE WHEN {c} = 0 THEN 1 END) AS n_zeros, count(CASE WHEN {c} < 0 THEN 1 END) AS n_negative,
        {quantiles}, round(max({x}) - min({x}), 7) AS range,
        round(quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25), 7) AS iqr,
        round(count(CASE WHEN {c} = 0 THEN 1 END) / count(*), 7) AS p_zeros,
        round(count(CASE WHEN {c} < 0 THEN 1 END) / count(*), 7) AS p_negative
        FROM lineitem"""


def _string_sql(c):
    return f"""SELECT {_common_sql(c, 'text')},
        CAST(min(length({c})) AS INTEGER) AS min_length, CAST(max(length({c})) AS INTEGER) AS max_length,
        round(avg(length({c})), 7) AS mean_length, count(CASE WHEN length({c}) = 0 THEN 1 END) AS n_empty,
        round(quantile_cont(CAST(length({c}) AS DOUBLE), 0.5), 7) AS median_length
        FROM documents"""


def _top_sql(c):
    return f"""SELECT '{c}' AS column_name, CAST(row_number() OVER (ORDER BY n DESC, value) AS INTEGER) AS rank, value, n
        FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c}) g"""


def _nan_last_sql(p):
    """Quantile over sorted values x of which there are n with those that count as NaN."""
    low, high = f"CAST(floor({p} * (n - 1)) AS BIGINT) + 1", f"CAST(ceil({p} * (n - 1)) AS BIGINT) + 1"
    part = f"({p} * (n - 1) - floor({p} * (n - 1)))"
    return f"""CASE WHEN {high} > len(x) THEN 'NaN'::DOUBLE
        ELSE round(x[{low}] + (x[{high}] - x[{low}]) * {part}, 7) END"""


def _pairs_sql(source, columns, value):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS first, '{b}' AS second, {value(a, b)} FROM {source}"
        for i, a in enumerate(columns) for b in columns[i + 1 :]
    )


def _pearson_sql(a, b):
    return f"round(corr({a}, {b}), 7) AS correlation, count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS n"


def _rank_sql(column):
    of = f"PARTITION BY {column} IS NULL"
    place = f"rank() OVER ({of} ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2.0"
    return f"CASE WHEN {column} IS NOT NULL THEN {place} END AS {column}"


def _cramer_sql(a, b):
    cells = f"SELECT {a} AS a, {b} AS b, count(*) AS c FROM coded WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2"
    return f"""
        SELECT '{a}' AS first, '{b}' AS second,
               round(sqrt((sum(c * c / (ra * CAST(rb AS DOUBLE))) - 1) / (least(count(DISTINCT a), count(DISTINCT b)) - 1)), 7) AS cramers_v,
               CAST(sum(c) AS BIGINT) AS n
        FROM (SELECT *, sum(c) OVER (PARTITION BY a) AS ra, sum(c) OVER (PARTITION BY b) AS rb FROM ({cells}) x) y"""


def _histogram_sql(column, bins=8):
    return f"""
        SELECT '{column}' AS column_name, CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * ((hi - lo) / {bins}), 7) AS lower,
               round(CASE WHEN g.bin = {bins - 1} THEN hi ELSE lo + (g.bin + 1) * ((hi - lo) / {bins}) END, 7) AS upper,
               coalesce(k.n, 0) AS n
        FROM (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM lineitem) e,
             (SELECT unnest(range(0, {bins})) AS bin) g
        LEFT JOIN (
          SELECT least(floor(({column} - lo) / ((hi - lo) / {bins})), {bins - 1}) AS bin, count(*) AS n
          FROM lineitem, (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM lineitem) f
          WHERE {column} IS NOT NULL GROUP BY 1) k ON k.bin = g.bin"""


_CODED = ("o_orderstatus", "o_orderpriority", "month")

def _merged_sql(column, numeric):
    figures = ("min", "max", "avg") if numeric else ()
    named = ", ".join(
        (f"round({f}(CAST({column} AS DOUBLE)), 7)" if f in figures else "CAST(NULL AS DOUBLE)") + f" AS {name}"
        for f, name in (("min", "min"), ("max", "max"), ("avg", "mean"))
    )
    return f"""
        SELECT 'orders' AS table_name, '{column}' AS column_name, count(DISTINCT year(o_orderdate)) AS loads, count(*) AS n,
               count(*) - count({column}) AS n_missing, {named}, true AS distinct_close,
               {'true' if numeric else 'CAST(NULL AS BOOLEAN)'} AS median_close
        FROM orders"""


_TOP_SQL = f"SELECT * FROM ({' UNION ALL '.join(_top_sql(c) for c in CODES)}) t WHERE rank <= {TOP}"

SQL = {
    "profile_merged": " UNION ALL ".join(
        _merged_sql(c, c in ("o_totalprice", "o_custkey")) for c in SUMMARISED
    ),
    "profile_top_values_bounded": _TOP_SQL,
    "profile_correlations": _pairs_sql("lineitem", NUMBERS, _pearson_sql),
    "profile_rank_correlations": f"""
        WITH r AS (SELECT {', '.join(map(_rank_sql, RANKED))}
                   FROM (SELECT floor(value) AS value, user_id, event_id FROM events) e)
        {_pairs_sql('r', RANKED, _pearson_sql)}""",
    "profile_associations": "WITH coded AS (SELECT o_orderstatus, o_orderpriority, strftime(o_orderdate, '%m') AS month FROM orders) "
        + " UNION ALL ".join(_cramer_sql(a, b) for i, a in enumerate(_CODED) for b in _CODED[i + 1 :]),
    "profile_histogram": " UNION ALL ".join(map(_histogram_sql, NUMBERS)),
    "profile_repeated_rows": "SELECT text, lang, source, count(*) AS copies FROM documents GROUP BY ALL HAVING count(*) > 1",
    "profile_numeric_nan": f"""
        SELECT 'price' AS column_name, n, {", ".join(f"{_nan_last_sql(p)} AS {q}" for q, p in P.QUANTILES.items())}
        FROM (SELECT count(*) AS n, list_sort(list(l_extendedprice) FILTER (l_returnflag <> 'R')) AS x FROM lineitem) l""",
    "profile_table_approx": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n, count(*) - count({c}) AS n_missing, true AS is_close FROM {t}"
        for t, columns in TABLES.items()
        for c in columns
    ),
    "profile_dates": f"""SELECT {_common_sql("o_orderdate", "date")},
        min(o_orderdate) AS min, max(o_orderdate) AS max,
        CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS INTEGER) AS range_days FROM orders""",
    "profile_numeric": " UNION ALL ".join(_numeric_sql(c) for c in NUMBERS),
    "profile_string": " UNION ALL ".join(_string_sql(c) for c in TEXTS),
    "profile_top_values": _TOP_SQL,
    "profile_table": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {_common_sql(c, KINDS.get(c, 'numeric'))} FROM {t}"
        for t, columns in TABLES.items()
        for c in columns
    ),
    "profile_overview": """
        SELECT n, CAST(5 AS BIGINT) AS n_var, missing AS n_cells_missing, round(missing / (n * 5), 7) AS p_cells_missing,
               CAST((q > 0)::INT + (t > 0)::INT AS BIGINT) AS n_vars_with_missing,
               CAST((q = n)::INT + (t = n)::INT AS BIGINT) AS n_vars_all_missing,
               CAST(3 AS BIGINT) AS n_numeric, CAST(0 AS BIGINT) AS n_date, CAST(2 AS BIGINT) AS n_text,
               CAST(0 AS BIGINT) AS n_boolean, CAST(0 AS BIGINT) AS n_other
        FROM (SELECT count(*) AS n, count(*) - count(quality) AS q, count(*) - count(toxic) AS t,
                     2 * count(*) - count(quality) - count(toxic) AS missing
              FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) x""",
}
