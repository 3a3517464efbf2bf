"""Records of CSV files that have line breaks inside quoted cells, read by many tasks per file.

Spark splits a file into byte ranges and a task reads the lines that begin in its range. A line begins
a record if the quotes before it in the file are even in number. One pass counts the quotes of every
range; summed up over the ranges of a file they tell each task whether it starts inside a quoted
cell. The second pass joins lines to records; the two pieces of a record that a range's end cuts meet
in a small shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.session import few_rows, ship_package

QUOTE = '"'
_OUT = "range int, place bigint, piece int, record string"
#: Pieces of records: the rest of one begun in an earlier range, a whole one, one that a later range ends.
_REST, _WHOLE, _OPEN = 0, 1, 2


class OpenQuoteError(ValueError):
    """A file has an odd number of quotes, so its last record never ends."""


def _lines(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    lines = spark.read.options(**options).text(path, lineSep="\n")
    return lines.select(
        "value", F.input_file_name().alias("path"), F.col("_metadata.file_block_start").alias("start"),
    )


def _ranges(lines: DataFrame) -> list[tuple[int, str, int, bool]]:
    """(range, path, start, begins inside a quoted cell) in the order of paths and places."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    # a line per range, as many as Spark's own list of them
    counted = lines.groupBy("path", "start").agg((F.sum(quotes) % 2).alias("odd")).orderBy("path", "start").collect()
    ranges, inside, last = [], False, None
    for number, row in enumerate(counted):
        if row["path"] != last:
            if inside:
                raise OpenQuoteError(last)
            last = row["path"]
        ranges.append((number, row["path"], row["start"], inside))
        inside ^= bool(row["odd"])
    if inside:
        raise OpenQuoteError(last)
    return ranges


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (value, range, inside) in order to pieces of records."""
    current, place, odd, begun, held = None, 0, False, False, []

    def piece(last: bool) -> tuple[int, int, int, str]:
        """What is held: `last` if the range ends here with the record still open."""
        kind = _REST if not begun else _OPEN if last else _WHOLE
        return current, place, kind, "\n".join(held)

    for batch in batches:
        values, numbers = batch.column(0), batch.column(1).to_numpy()
        odds = pc.count_substring(values, QUOTE).to_numpy() % 2 == 1
        starts_inside = batch.column(2).to_numpy(zero_copy_only=False)
        edges = np.concatenate([[0], np.flatnonzero(numbers[1:] != numbers[:-1]) + 1, [len(numbers)]])
        out: list[tuple[int, int, int, str]] = []
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            if numbers[a] != current:
                if held:
                    out.append(piece(True))
                current, place, odd, held = int(numbers[a]), 0, bool(starts_inside[a]), []
                begun = not odd
            texts = values.slice(a, b - a).to_pylist()
            for text, flips in zip(texts, odds[a:b]):
                held.append(text)
                odd ^= bool(flips)
                if not odd:
                    out.append(piece(False))
                    # empty records are left out, the header is the first of the others
                    place, begun, held = place + (held not in ([""], ["\r"])), True, []
        yield _batch(out)
    if held:
        yield _batch([piece(True)])


def _batch(rows: list[tuple[int, int, int, str]]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.string()]
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["range", "place", "piece", "record"])


def csv_records(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(path, header, record): every record of the CSV files at `path` that is not empty, with its line breaks;
    `header` marks the first of a file.

    Records end with a line feed, or a carriage return and a line feed, outside of quotes; quotes stand only
    around cells and are doubled inside (RFC 4180). A file whose quotes don't pair up raises
    `OpenQuoteError`. A record is held in memory, a file or range never is.
    """
    ship_package(spark)
    lines = _lines(spark, path, options)
    ranges = few_rows(spark, _ranges(lines), "range int, path string, start bigint, inside boolean")
    # a line per range; a broadcast join leaves the order of the lines as it is
    known = lines.join(F.broadcast(ranges), ["path", "start"]).select("value", "range", "inside")
    pieces = known.mapInArrow(_joined, _OUT)
    where = F.broadcast(ranges.select("range", "path", "start"))
    pieces = pieces.join(where, "range")
    first = (F.col("start") == 0) & (F.col("place") == 0)
    whole = pieces.where(F.col("piece") == _WHOLE).select("path", first.alias("header"), "record")
    # at most two pieces per range; a record is the open piece and the rests up to the next open one
    cut = pieces.where(F.col("piece") != _WHOLE)
    order = Window.partitionBy("path").orderBy("range", "piece")
    cut = cut.withColumn("nth", F.count_if(F.col("piece") == _OPEN).over(order))
    parts = F.sort_array(F.collect_list(F.struct("range", "record")))
    met = cut.groupBy("path", "nth").agg(parts.alias("parts"), F.max(first & (F.col("piece") == _OPEN)).alias("header"))
    met = met.select("path", "header", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    every = whole.unionByName(met)
    ended = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return every.select("path", "header", ended.alias("record")).where("record <> ''")
