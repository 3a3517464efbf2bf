"""Left joins that hold up when one key carries a large share of either side."""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20

_VARIABLE = (T.StringType, T.BinaryType)
_SKETCHED = (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
#: Values the built-in sketch of frequent ones tracks at most.
_TRACKED = 1_000_000


def _size(df: DataFrame) -> Column | None:
    fields = df.schema.fields
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in fields):
        return None
    per_row = F.lit(8 * len(fields)).cast("bigint")
    for f in fields:
        if isinstance(f.dataType, _VARIABLE):
            per_row = per_row + F.coalesce(F.octet_length(f.name), F.lit(0))
    return F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint")


def size_in_bytes(df: DataFrame) -> int | None:
    """Measured size of the rows, by one aggregate over them; None if a column is nested."""
    size = _size(df)
    return None if size is None else df.agg(size).first()[0]


class Measurement:
    """Size and frequent values of some columns of a table, found by one aggregate over it, without a shuffle of
    its rows, when first asked for. Joins that share one don't run the table again.

    Frequent are values with more than `share` of the rows, by default twice an even share of a shuffle partition.
    They come from a sketch per column that tracks 16 values for each that could be that frequent: counts
    are wrong by less than a quarter of that share, which moves salts, not results. A type that the sketch does not
    take has its values counted (`hot_values`).
    """

    def __init__(self, df: DataFrame, *columns: str, share: float | None = None):
        self.df, self.columns = df, columns
        self.share = 2 / _partitions(df) if share is None else share
        self._counted: dict[str, dict] = {}

    def _sketched(self, column: str) -> bool:
        return isinstance(self.df.schema[column].dataType, _SKETCHED)

    @cached_property
    def _row(self) -> dict:
        size = _size(self.df)
        found = [F.count("*").alias("rows"), (F.lit(None) if size is None else size).alias("size")]
        tracked = min(_TRACKED, 1 << math.ceil(math.log2(max(64, 16 / self.share))))
        # missing keys may be the most frequent value of all
        most = min(tracked, math.ceil(1 / self.share) + 1)
        for i, c in enumerate(self.columns):
            if self._sketched(c):
                name = "`" + c.replace("`", "``") + "`"
                found.append(F.expr(f"approx_top_k({name}, {most}, {tracked})").alias(f"top{i}"))
        return self.df.agg(*found).first().asDict()

    @property
    def size(self) -> int | None:
        """Bytes of the rows; None if a column is nested."""
        return self._row["size"]

    def hot(self, column: str) -> dict:
        """Frequent values of one of the columns with their share of the rows, the greatest first."""
        if not self._sketched(column):
            if column not in self._counted:
                self._counted[column] = hot_values(self.df, column, self.share)
            return self._counted[column]
        rows = self._row["rows"]
        top = self._row[f"top{self.columns.index(column)}"]
        often = [(t["item"], t["count"] / rows) for t in top if t["item"] is not None and t["count"] > self.share * rows]
        return dict(sorted(often, key=lambda x: -x[1]))


def hot_values(df: DataFrame, column: str, share: float) -> dict:
    """Values holding more than `share` of the rows, at most 1/share of them, with their share,
    the greatest first.

    One pass over the column counts hash buckets, several for each value that could be that
    frequent. Only if a bucket is that full are its values counted, in a second pass; so nothing is
    shuffled per distinct value of the whole column, and the driver gets full buckets only.
    """
    keys = df.select(column)
    buckets = max(64, math.ceil(8 / share))
    bucket = F.when(F.col(column).isNotNull(), F.pmod(F.xxhash64(column), F.lit(buckets)))
    sizes = keys.groupBy(bucket.alias("bucket")).count()
    # the window goes over one row per bucket
    sizes = sizes.withColumn("total", F.sum("count").over(Window.partitionBy()))
    rows = sizes.where(F.col("bucket").isNotNull() & (F.col("count") > share * F.col("total"))).collect()
    if not rows:
        return {}
    full, total = [r["bucket"] for r in rows], rows[0]["total"]
    counts = keys.where(bucket.isin(full)).groupBy(column).count()
    found = counts.where(F.col("count") > share * total).orderBy(F.desc("count")).collect()
    return {value: n / total for value, n in found}


def _partitions(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    first = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(first or conf.get("spark.sql.shuffle.partitions"))


def _hot_salts(measured: Measurement, key: str) -> dict:
    """How many tasks each frequent value of `key` is spread over: enough that a task gets about
    an even share of the rows. The salts add
    up to no more than the shuffle partitions plus the number of values, so repeating the other
    side's matching rows that often stays small."""
    partitions = _partitions(measured.df)
    return {v: max(2, math.ceil(s * partitions)) for v, s in measured.hot(key).items()}


def _is_hot(key: str, hot: Mapping) -> Column:
    return F.coalesce(F.col(key).isin(list(hot)), F.lit(False)) if hot else F.lit(False)


def _salts_of(df: DataFrame, key: str, hot: Mapping) -> Column:
    """Number of salts of a hot key; the map is searched from the most frequent value on."""
    if not hot:
        return F.lit(1)
    t = df.schema[key].dataType
    pairs = [c for v, n in hot.items() for c in (F.lit(v).cast(t), F.lit(n))]
    return F.element_at(F.create_map(*pairs), F.col(key))


def _scattered(df: DataFrame, key: str, hot: Mapping, name: str) -> DataFrame:
    """Add the salt of each row: a hash of the row alone, so a repeated task repeats it, for hot
    and NULL keys and 0 for others."""
    columns = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    row = F.xxhash64(*columns)
    salt = F.when(F.col(key).isNull(), F.pmod(row, F.lit(_partitions(df))))
    salt = salt.when(_is_hot(key, hot), F.pmod(row, _salts_of(df, key, hot)))
    return df.withColumn(name, salt.otherwise(0).cast("int"))


def _copied(df: DataFrame, key: str, hot: Mapping, name: str) -> DataFrame:
    """Repeat the rows of hot keys once per salt."""
    every = F.sequence(F.lit(0), _salts_of(df, key, hot) - 1)
    return df.withColumn(name, F.explode(F.when(_is_hot(key, hot), every).otherwise(F.array(F.lit(0)))))


def _salted(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: Mapping, how: str
) -> DataFrame:
    left = _scattered(left, left_key, hot, "_salt")
    right = _copied(right, right_key, hot, "_copy")
    on = (left[left_key] == right[right_key]) & (left["_salt"] == right["_copy"])
    return left.join(right, on, how).drop("_salt", "_copy")


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float | None = None,
    hot_from: DataFrame | Measurement | None = None,
) -> DataFrame:
    """LEFT OUTER equi-join keeping every row of `left` and every match in `right`, fan-out
    included. Column names of the two sides must differ; both sides' columns are returned.

    `right` is broadcast only if its measured size is at most `broadcast_bytes`. Otherwise
    rows of `left` with a frequent or NULL key are spread over several tasks, the matching rows
    of `right` being repeated. A key frequent in `right` is joined on its own, with `right` spread
    and the rows of `left` repeated; if it is frequent in `left` too, both are spread, and every part
    of the one meets every part of the other. It is known to match, so that part is an inner join.
    Frequent keys of `left` are looked for in `hot_from` if given, a stored table with the rows of
    `left`, which saves running a `left` that is itself a join once more, or a `Measurement` of it that several joins
    share. Before the join itself `right` is run once, and if it is not broadcast `left` or `hot_from` once, unless
    it has been measured.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"both sides have columns {sorted(shared)}")
    seen = Measurement(right, right_key, share=hot_share)
    if seen.size is not None and seen.size <= broadcast_bytes:
        return left.join(F.broadcast(right), left[left_key] == right[right_key], "left")
    heavy = _hot_salts(seen, right_key)
    if not isinstance(hot_from, Measurement):
        hot_from = Measurement(left if hot_from is None else hot_from, left_key, share=hot_share)
    hot = _hot_salts(hot_from, left_key)
    both = {v: n for v, n in hot.items() if v in heavy}
    hot = {v: n for v, n in hot.items() if v not in heavy}
    if not heavy:
        return _salted(left, right, left_key, right_key, hot, "left")
    usual = _salted(
        left.where(~_is_hot(left_key, heavy)), right.where(~_is_hot(right_key, heavy)),
        left_key, right_key, hot, "left",
    )
    mine, theirs = left.where(_is_hot(left_key, heavy)), right.where(_is_hot(right_key, heavy))
    mine = _copied(_scattered(mine, left_key, both, "_part"), left_key, heavy, "_copy")
    theirs = _copied(_scattered(theirs, right_key, heavy, "_salt"), right_key, both, "_meets")
    on = (mine[left_key] == theirs[right_key]) & (mine["_copy"] == theirs["_salt"]) & (mine["_part"] == theirs["_meets"])
    return usual.unionByName(mine.join(theirs, on, "inner").drop("_part", "_copy", "_salt", "_meets"))


def left_anti_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float | None = None,
) -> DataFrame:
    """Rows of `left` whose key is NULL or not in `right`. Beyond the broadcast limit, repeats in
    `right` are removed by a pre-aggregated distinct, so only `left` can be skewed; its frequent keys
    are spread."""
    right = right.select(right_key).where(F.col(right_key).isNotNull())
    size = size_in_bytes(right)
    if size is not None and size <= broadcast_bytes:
        return left.join(F.broadcast(right), left[left_key] == right[right_key], "left_anti")
    right = right.distinct()
    hot = _hot_salts(Measurement(left, left_key, share=hot_share), left_key)
    return _salted(left, right, left_key, right_key, hot, "left_anti")
