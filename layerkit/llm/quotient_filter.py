"""Exact duplicates found by counting quotient filters.

Every partition counts its fingerprints in a counting quotient filter: the upper bits of a
fingerprint are its quotient, the rest its remainder, kept in ascending order with a counter. Since
nothing of a fingerprint is lost, filters merge without loss by merging sorted remainders and adding
counters. A filter is kept in blocks of consecutive quotients, so blocks of the same quotients meet
in one task and no task sees more than a block. Fingerprints counted more than once send their
documents to the byte comparison, the rest are done.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import column, stored, text_slices

#: Fingerprints a merged block holds on average.
BLOCK = 1 << 20
_BLOCK_ROWS = "block bigint, quotients binary, runs binary, remainders binary, counts binary"


def insert(fingerprints: np.ndarray, bits: int) -> list[tuple]:
    """Quotient filter of the fingerprints with 2^`bits` blocks: per block its occupied
    quotients, the length of each one's run, and the runs' sorted remainders with counters."""
    values, counts = np.unique(fingerprints, return_counts=True)
    return _blocks(values, counts.astype(np.uint64), bits)


def _quotient_bits(bits: int) -> int:
    """A block has 2^16 quotients."""
    return min(bits + 16, 48)


def _blocks(values: np.ndarray, counts: np.ndarray, bits: int) -> list[tuple]:
    if not len(values):
        return []
    low = np.uint64(64 - _quotient_bits(bits))
    block = (values >> np.uint64(64 - bits)) if bits else np.zeros(len(values), np.uint64)
    edges = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(values))
    rows = []
    for a, b in zip(edges[:-1], edges[1:]):
        quotients, runs = np.unique(values[a:b] >> low, return_counts=True)
        remainders = values[a:b] & ((np.uint64(1) << low) - np.uint64(1))
        rows.append((
            int(block[a]), quotients.tobytes(), runs.astype(np.uint32).tobytes(),
            remainders.tobytes(), counts[a:b].tobytes(),
        ))
    return rows


def entries(quotients: bytes, runs: bytes, remainders: bytes, counts: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints in ascending order and their counts, read back from a block."""
    low = np.uint64(64 - _quotient_bits(bits))
    each = np.repeat(np.frombuffer(quotients, np.uint64), np.frombuffer(runs, np.uint32))
    return (each << low) | np.frombuffer(remainders, np.uint64), np.frombuffer(counts, np.uint64)


def merge(blocks: list[tuple], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge blocks of the same quotients by their sorted remainders, adding counters."""
    parts = [entries(*b, bits) for b in blocks]
    values = np.concatenate([v for v, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], np.add.reduceat(counts, first)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, digest): XXH64 and SHA-256 of the text with A-Z lowered, null as
    empty."""
    rows = docs.select(column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"))
    schema = rows.select("doc_id", F.lit(0).cast("bigint").alias("fingerprint"), F.lit(b"").alias("digest")).schema

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, shas = [], []
            for _, run in text_slices(batch.column(1)):
                for value in run:
                    value = value.lower()
                    prints.append(xxhash.xxh64_intdigest(value))
                    shas.append(hashlib.sha256(value).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(shas, pa.binary())],
                names=["doc_id", "fingerprint", "digest"],
            )

    return rows.mapInArrow(compute, schema)


def repeated_fingerprints(prints: DataFrame, rows: int) -> DataFrame:
    """(fingerprint, copies) of the fingerprints counted more than once among `rows` ones."""
    bits = max(0, (rows // BLOCK).bit_length())
    bits = max(bits, (int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= 4 * BLOCK:
                yield rows_of(held)
                held = []
        if held:
            yield rows_of(held)

    def rows_of(held: list[np.ndarray]) -> pa.RecordBatch:
        found = insert(np.concatenate(held), bits)
        kinds = [pa.int64(), *[pa.binary()] * 4]
        arrays = [pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "quotients", "runs", "remainders", "counts"])

    def merged(table: pa.Table) -> pa.Table:
        values, counts = merge([tuple(r.values()) for r in table.drop(["block"]).to_pylist()], bits)
        many = counts > 1
        return pa.table({
            "fingerprint": pa.array(values[many].view(np.int64)),
            "copies": pa.array(counts[many].astype(np.int64)),
        })

    filters = prints.select("fingerprint").mapInArrow(build, _BLOCK_ROWS)
    return filters.groupBy("block").applyInArrow(merged, "fingerprint bigint, copies bigint")


def _lowered(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with A-Z lowered and null as empty."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pc.ascii_lower(pc.fill_null(batch.column(1), ""))
            yield pa.RecordBatch.from_arrays([batch.column(0), text], names=["doc_id", "text"])

    return docs.mapInArrow(compute, docs.schema)


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: `doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal if identical after lowering A-Z; null counts as empty. Of equal texts the row
    with the largest id stays, any id before a null one; of repeated rows of that id one stays.
    Documents whose fingerprint the filters counted once are kept without further work. The others
    are grouped by their text itself, pre-aggregated before the shuffle, so a group of copies
    however large is one row per task. An empty table gives no rows.
    """
    rows = docs.select(column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"))
    found = stored(digests(rows), "digests")
    repeated = stored(repeated_fingerprints(found, found.count()), "repeated")
    routed = found.join(repeated, "fingerprint", "left_semi").select("doc_id").distinct()
    routed = routed.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"))
    texts = rows.join(
        routed,
        (F.coalesce(rows["doc_id"], F.lit(0)) == F.col("_id")) & (rows["doc_id"].isNull() == F.col("_none")),
        "left_semi",
    )
    equal = _lowered(texts).groupBy("text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    classes = equal.where("group_size > 1").select(
        F.unhex(F.sha2("text", 256)).alias("digest"), "keep_id", "group_size"
    )
    copies = found.groupBy("doc_id", "digest").agg(F.count("*").alias("copies"))
    each = copies.select("doc_id", "digest", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    marked = each.join(classes, "digest", "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return marked.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
