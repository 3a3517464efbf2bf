"""Layered tables: one database and one folder per layer, full refresh on every load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")


def create_layers(spark: SparkSession, layers: Sequence[str] = LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def create_table(spark: SparkSession, root: str, table: str, schema: T.StructType) -> None:
    """Drop `table` (layer.name) if it exists and create it empty."""
    write_table(spark.createDataFrame([], schema), root, table)


def write_table(df: DataFrame, root: str, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace `table` (layer.name) by the rows of `df` and return it as stored. Repeating
    the call leaves the same table."""
    spark = df.sparkSession
    layer, name = table.split(".")
    if columns is not None:
        df = df.select(*columns)
    df.write.mode("overwrite").option("path", f"{root}/{layer}/{name}").format("parquet").saveAsTable(table)
    return spark.table(table)


def publish_view(df: DataFrame, table: str) -> DataFrame:
    """Make `df` readable as a temporary view, `layer.name` becoming `layer_name`."""
    name = table.replace(".", "_")
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
