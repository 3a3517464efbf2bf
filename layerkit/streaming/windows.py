"""Event counts in tumbling windows, batch and streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tumbling_counts(df: DataFrame, at: str, by: Sequence[str], width: str) -> DataFrame:
    """(window_start, window_end, by..., n)."""
    counts = df.groupBy(F.window(at, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n"
    )


def tumbling_counts_stream(stream: DataFrame, at: str, by: Sequence[str], width: str, late: str) -> DataFrame:
    """The same over a stream, dropping events later than `late`. Watermarks need a zoned
    timestamp, so a zone-less one is read in the session's time zone, which should be UTC."""
    zoned = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return tumbling_counts(zoned, at, by, width)


def append_closed_windows(counts: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write each window once, when the watermark has passed its end; state holds open
    windows only."""
    return (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
