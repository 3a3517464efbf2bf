"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.session import new_path

WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the shared folder and read again: what follows neither repeats its
    work nor sees other rows after an executor is lost."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(taken: Sequence[str], *wanted: str) -> list[str]:
    """`wanted` names, lengthened until they differ from all `taken` ones, ignoring case."""
    used, names = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        names.append(name)
    return names


def column(df: DataFrame, name: str) -> Column:
    """The column of that very name, also if it has dots."""
    return df["`" + name.replace("`", "``") + "`"]


def content_key(columns: Sequence[Column]) -> list[Column]:
    """Two independent 64-bit hashes of the values; a null differs from an empty text and from
    a null elsewhere."""
    parts = [p for c in columns for p in (c.isNull(), c)]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def row_key(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """`df` with the content key of its rows under the two `names`: equal for repeated rows."""
    keys = content_key([column(df, f.name) for f in df.schema.fields if not _has_map(f.dataType)])
    return df.select("*", *[k.alias(n) for k, n in zip(keys, names)])


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind.fields)


def utf8(values: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [v or b"" for v in values.cast(pa.binary()).to_pylist()]


def text_slices(values: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """The texts in runs of about `most` bytes, with the place of the first, so that the work on
    a run takes bounded memory however long the texts of a batch are together."""
    start = 0
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    while start < len(values):
        end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), most)))
        yield start, utf8(values.slice(start, end - start))
        start = end
