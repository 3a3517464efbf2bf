"""Typed CSV loads and CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.session import few_rows
from layerkit.sources.records import csv_records

# read options under which an unquoted empty cell is NULL, "" is the empty string, quotes are
# escaped by doubling, columns map by position and any bad cell fails the load
CSV_LOAD = {
    "header": "true",
    "enforceSchema": "true",
    "mode": "FAILFAST",
    "nullValue": "\u0001",
    "emptyValue": "",
    "quote": '"',
    "escape": '"',
}


def _ddl(schema: T.StructType) -> str:
    return ", ".join("`" + f.name.replace("`", "``") + f"` {f.dataType.simpleString()}" for f in schema.fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Load a CSV file or folder as it is. `multi_line` allows line breaks inside quoted
    cells; files are split over tasks all the same."""
    if multi_line:
        cells = F.from_csv("record", _ddl(schema), CSV_LOAD | {"multiLine": "true", "header": "false"})
        parsed = csv_records(spark, path).where("NOT header").select(cells.alias("cells"))
        return parsed.select([F.col("cells")[f.name].alias(f.name) for f in schema.fields])
    return spark.read.options(**CSV_LOAD).option("columnPruning", "false").schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder with a header in every part; NULL is written as an empty cell, the empty
    string as "", so `read_csv` gives back the same rows."""
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .csv(path)
    )


def count_csv_rows(spark: SparkSession, folder: str, multi_line: bool = False) -> DataFrame:
    """Data rows (lines less the header) of every *.csv file below `folder`, 0 for an empty
    file: (file, n)."""
    options = {"pathGlobFilter": "*.csv", "recursiveFileLookup": "true"}
    lines = spark.read.text(folder, **options)
    # the listing has empty files too, which a scan leaves out
    files = few_rows(spark, [(path, path.rsplit("/", 1)[-1]) for path in sorted(set(lines.inputFiles()))], "path string, file string")
    located = csv_records(spark, folder, **options).select(F.col("path").alias("at")) if multi_line else lines.select(
        F.input_file_name().alias("at")
    )
    counts = located.groupBy("at").agg(F.count(F.lit(1)).alias("lines"))
    rows = F.greatest(F.coalesce("lines", F.lit(0)) - 1, F.lit(0)).cast("bigint")
    return files.join(counts, files["path"] == counts["at"], "left").select(
        "path", F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("file"), rows.alias("n")
    )
