"""Incremental loads of a drop folder."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from layerkit.sources.csv import CSV_LOAD


def ingest_csv(
    spark: SparkSession, folder: str, schema: T.StructType, target: str, checkpoint: str
) -> StreamingQuery:
    """Append the rows of CSV files not seen before to the parquet table at `target`, then
    stop. `checkpoint` remembers the files between calls; the file sink keeps a repeated
    batch from being added twice."""
    rows = spark.readStream.schema(schema).options(**CSV_LOAD).option("columnPruning", "false").csv(folder)
    return (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
