"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.session import few_rows, new_path

def surrogate_key(
    df: DataFrame,
    order_by: Sequence[str],
    tie: Sequence[str],
    name: str = "surrogate_key",
    path: str | None = None,
) -> DataFrame:
    """Add `name` = 1..n (bigint), the position of the row by `order_by` then `tie`, all
    ascending with NULLs last: what `row_number() over (order by ...)` gives, but sorted by
    range partitions over all tasks.

    The rows are stored with a running id before they are sorted, in the shared folder or
    below `path`, replacing what is there. The id is the last sort column: it splits copies of
    one row, however many, over several partitions, and being stored it does not change when a
    task is repeated. The sorted rows are stored with the number of their sort partition and
    their place in there; a row's key is that place plus the rows in earlier partitions.
    Re-reading after a lost executor thus gives the same keys. `tie` decides between rows equal
    in `order_by`.
    """
    own = {"_at", "_row", "_part", "_before", name.lower()} & {c.lower() for c in df.columns}
    if own:
        raise ValueError(f"the rows already have columns {sorted(own)}")
    spark = df.sparkSession
    mode = "error" if path is None else "overwrite"
    path = path or new_path(spark, name)
    df.withColumn("_at", F.monotonically_increasing_id()).write.mode(mode).parquet(f"{path}/rows")
    schema = T.StructType([*df.schema.fields, T.StructField("_at", T.LongType())])
    stored = spark.read.schema(schema).parquet(f"{path}/rows")
    ordered = stored.orderBy(*[F.col(c).asc_nulls_last() for c in [*order_by, *tie, "_at"]]).drop("_at")
    # the upper bits of this id are the partition, the lower 33 count its rows from 0
    ordered.withColumn("_row", F.monotonically_increasing_id()).write.mode(mode).parquet(f"{path}/sorted")

    schema = T.StructType([*df.schema.fields, T.StructField("_row", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{path}/sorted").withColumn("_part", F.shiftright("_row", 33))
    # one line per sort partition
    sizes = sorted(tuple(r) for r in rows.groupBy("_part").count().collect())
    before, starts = 0, []
    for part, size in sizes:
        starts.append((part, before))
        before += size
    starts = few_rows(spark, starts, "_part bigint, _before bigint")
    place = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    key = (F.col("_before") + place + 1).alias(name)
    return rows.join(F.broadcast(starts), "_part").select(key, *df.columns)


def stable_key(
    df: DataFrame,
    business: Sequence[str],
    order_by: Sequence[str],
    register: str,
    load: int,
    name: str = "surrogate_key",
) -> DataFrame:
    """Add `name`, a bigint that a business key keeps for good, however many rows arrive later.

    `register` is a folder that holds the keys given out so far, one part per load. Keys of this load
    that are not in the parts of earlier loads get the numbers after the largest one, without gaps,
    by `order_by` and then `business`, NULLs last; nothing is renumbered. NULL is a key of its own.
    A load that is repeated replaces its part and finds the same numbers.
    """
    if name in df.columns:
        raise ValueError(f"the rows already have a column {name!r}")
    spark = df.sparkSession
    fields = [df.schema[c] for c in business]
    layout = T.StructType([*fields, T.StructField(name, T.LongType()), T.StructField("load", T.LongType())])
    given = spark.read.schema(layout).option("basePath", register).option("ignoreMissingFiles", "true")
    # the first load finds no folder yet
    spark.createDataFrame([], T.StructType([*fields, layout[name]])).write.mode("ignore").parquet(f"{register}/load=-1")
    known = given.parquet(register).where(F.col("load") < load)
    place = [F.min(F.struct(F.col(c).isNull(), F.col(c))).alias(f"_o{i}") for i, c in enumerate(order_by) if c not in business]
    wanted = df.groupBy(*business).agg(*place) if place else df.select(*business).distinct()
    same = reduce(and_, [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in business])
    new = wanted.alias("n").join(known.alias("k"), same, "left_anti")
    # the order of a key seen several times is its first
    ranks = {c: f"_o{i}" for i, c in enumerate(order_by) if c not in business}
    new = new.select(*business, *[F.col(f"{r}.{c}").alias(f"{r}v") for c, r in ranks.items()])
    numbered = surrogate_key(new, [f"{ranks[c]}v" if c in ranks else c for c in order_by], business, name)
    last = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    numbered.select(*business, (F.col(name) + last).alias(name)).write.mode("overwrite").parquet(f"{register}/load={load}")
    keys = given.parquet(register).where(F.col("load") <= load).drop("load")
    joined = df.alias("n").join(keys.alias("k"), same, "left")
    return joined.select(F.col(f"k.{name}").alias(name), *[F.col(f"n.{c}").alias(c) for c in df.columns])
