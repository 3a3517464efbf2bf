"""Figures over a run log: one row per (run, step, state, time)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def step_durations(log: DataFrame, by: list[str], at: str) -> DataFrame:
    """First and last time and the seconds between them, per group."""
    first, last = F.min(at), F.max(at)
    micros = F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))
    grouped = log.groupBy(*by).agg(
        first.alias("started"), last.alias("ended"), F.count(F.lit(1)).alias("entries")
    )
    return grouped.withColumn("duration_sec", F.round(micros / 1e6, 3))


def state_counts(log: DataFrame, state: str) -> DataFrame:
    return log.groupBy(F.col(state).alias("state")).agg(F.count(F.lit(1)).alias("n"))
