"""Row selection: newest row per key, rows still current."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest: str,
    tie: Sequence[str | Column],
) -> DataFrame:
    """One row per key: the greatest `newest`, a NULL counting as greatest, then `tie` in
    ascending order. Rows with a NULL key are dropped.

    The `= 1` filter lets Spark cut every input partition down to one row per key before
    the shuffle, so a key holding a large share of all rows does not fill one task.
    """
    order = [F.col(newest).desc_nulls_first()]
    order += [t if isinstance(t, Column) else F.col(t).asc_nulls_last() for t in tie]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df.withColumn("flag_last", rank).where("flag_last = 1").drop("flag_last")


def current_rows(df: DataFrame, end: str) -> DataFrame:
    """Rows whose validity has no end."""
    return df.where(F.col(end).isNull())
