"""SimHash near-duplicates by a positional byte index.

A fingerprint is eight positional bytes. Two fingerprints that differ in at most two bits differ in
at most two of them, so they share at least six: the guaranteed minimum. One-byte posting lists hold
1/256 of all fingerprints each, and tallying pairs over them would be quadratic. The index is
therefore kept by runs of the minimum: a fingerprint is posted under each of the 28 choices of six
positions with its six bytes there, and a pair reaches the minimum tally exactly if it meets in some
list. A list holds at most 2^16 fingerprints, those free in the two remaining bytes, whatever the
corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import column, row_key, stored, text_slices, unused
from layerkit.llm.words import pieces

SHINGLE = 3
MAX_BITS = 2
SEED = 42

#: The two positions left out by each list of the index.
FREE = list(combinations(range(8), 2))
_SCAN = 48


def _votes(hashes: list[int]) -> np.ndarray:
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits over the XXH64 of all word shingles, repeats included. Fewer words than a
    shingle are one shingle; without words the fingerprint is 0. Long texts are read piece by
    piece."""
    votes, total, carry = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for piece in pieces(text):
        words = carry + piece.lower().split()
        hashes = [digest(b" ".join(words[i : i + shingle]), SEED) for i in range(len(words) - shingle + 1)]
        if hashes:
            votes += _votes(hashes)
            total += len(hashes)
        carry = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
    if not total:
        if not carry:
            return 0
        votes, total = _votes([digest(b" ".join(carry), SEED)]), 1
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """`docs` without `text`, with `fingerprint` bigint, the 64 bits as a signed number."""
    rest = [c for c in docs.columns if c != text]
    out = docs.select(*[column(docs, c) for c in rest], F.lit(0).cast("bigint").alias("fingerprint"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = [fingerprint(t, shingle) for _, run in text_slices(texts) for t in run]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(signed)], names=[*rest, "fingerprint"]
            )

    return docs.select(*[column(docs, c) for c in rest], column(docs, text)).mapInArrow(compute, out.schema)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _postings(nodes: DataFrame) -> DataFrame:
    """One row per distinct fingerprint and list."""
    lists = []
    for k, (a, b) in enumerate(FREE):
        mask = ((1 << 64) - 1) ^ (0xFF << 8 * a) ^ (0xFF << 8 * b)
        shared = F.col("fingerprint").bitwiseAND(F.lit(_signed(mask)).cast("bigint"))
        lists.append(F.struct(F.lit(k).cast("tinyint").alias("list"), shared.alias("shared")))
    posted = nodes.select("fingerprint", F.explode(F.array(*lists)).alias("posting"))
    return posted.select("posting.list", "posting.shared", "fingerprint")


def _tally(x: np.ndarray) -> np.ndarray:
    """How many positional bytes agree, from the differing bits of pairs."""
    return (np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


def _flips(which: int, bits: int) -> np.ndarray:
    """All ways to change up to `bits` bits of the two free bytes of a list."""
    places = [8 * p + i for p in FREE[which] for i in range(8)]
    return np.array(
        [sum(1 << p for p in c) for n in range(1, bits + 1) for c in combinations(places, n)], np.uint64
    )


def _links_of_long(values: np.ndarray, which: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within one list, found by looking up the few values within reach of each one, so
    the work is in proportion to the list; `values` ascend. A value is linked to the least
    label around it until nothing changes, which leaves one link per value."""
    labels = np.arange(len(values))
    partners = []
    for flip in _flips(which, bits):
        wanted = values ^ flip
        at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
        here = np.flatnonzero(values[at] == wanted)
        if len(here):
            partners.append((here, at[here]))
    while True:
        new = labels.copy()
        for a, b in partners:
            np.minimum.at(new, a, labels[b])
        new = np.minimum(new, new[new])
        if (new == labels).all():
            break
        labels = new
    here = np.flatnonzero(labels != np.arange(len(values)))
    return values[here], values[labels[here]]


def _links(which: np.ndarray, shared: np.ndarray, values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of whole lists, whose rows follow each other."""
    new = np.ones(len(values), bool)
    new[1:] = (which[1:] != which[:-1]) | (shared[1:] != shared[:-1])
    run = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(values)))
    left, right = [], []
    for k in np.flatnonzero(sizes > _SCAN):
        own = np.sort(values[starts[k] : starts[k] + sizes[k]])
        a, b = _links_of_long(own, int(which[starts[k]]), bits)
        left.append(a)
        right.append(b)
    short = np.flatnonzero(sizes[run] <= _SCAN)
    values, run, which = values[short], run[short], which[short]
    for lag in range(1, min(_SCAN, int(sizes.max(initial=1)))):
        same = np.flatnonzero(run[lag:] == run[:-lag])
        if not len(same):
            break
        x = values[same] ^ values[same + lag]
        # shares the minimum of six bytes, and is verified bit by bit
        near = (_tally(x) >= 8 - bits) & (np.bitwise_count(x) <= bits)
        left.append(values[same][near])
        right.append(values[same + lag][near])
    if not left:
        return values[:0], values[:0]
    return np.concatenate(left), np.concatenate(right)


def links(nodes: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Links (u > v) between distinct fingerprints that differ in at most `bits` bits. Of a list
    with more than a few values, only as many links as keep them connected."""
    if not 0 < bits <= 2:
        raise ValueError("the index is made for one or two differing bits")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = rows if held is None else [np.concatenate(p) for p in zip(held, rows)]
            other = (held[0] != held[0][-1]) | (held[1] != held[1][-1])
            whole = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if whole:
                yield found([c[:whole] for c in held])
                held = [c[whole:] for c in held]
        if held is not None and len(held[0]):
            yield found(held)

    def found(rows: list[np.ndarray]) -> pa.RecordBatch:
        a, b = _links(rows[0], rows[1], rows[2].view(np.uint64), bits)
        a, b = a.view(np.int64), b.view(np.int64)
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])

    posted = _postings(nodes).repartition("list", "shared").sortWithinPartitions("list", "shared")
    return posted.mapInArrow(compute, "u bigint, v bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links `u`, `v`, root being the least node reachable.
    Alternating large and small stars: each round every node's neighbours move to the least of
    them, until only stars are left. Minima are pre-aggregated; rounds are written out."""
    edges = stored(edges.where("u <> v").distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "links")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        state = now


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = MAX_BITS) -> DataFrame:
    """One row per document: `doc_id`, `fingerprint` (16 hex digits) and `component_id`, the
    smallest id of the documents reachable over links of at most `bits` differing bits.

    Null texts and texts without words have fingerprint zero and are linked like any other. Ids may
    repeat or be null; a component of null ids alone has component null. Copies of a text share one
    fingerprint and are never paired; an empty table gives no rows.
    """
    one = docs.select(column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"))
    prints = stored(fingerprints(one), "fingerprints")
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    linked = components(links(nodes, bits)).withColumnRenamed("node", "fingerprint")
    rooted = nodes.join(linked, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = stored(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(ids, "root").select("fingerprint", "component_id")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return prints.join(classes, "fingerprint").select("doc_id", digits, "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = MAX_BITS) -> DataFrame:
    """`docs` with one document of each component: the one of the smallest id, nulls last; of
    rows with the same id, one. Columns and their values stay as they are."""
    keys = unused(["doc_id", "text"], "_key1", "_key2")
    one = row_key(docs, unused(docs.columns, *keys))
    names = one.columns[-2:]
    one = one.select(
        column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"),
        *[F.col(n).alias(k) for n, k in zip(names, keys)],
    )
    prints = stored(fingerprints(one), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *keys))
    nodes = stored(prints.groupBy("fingerprint").agg(first.alias("least")), "nodes")
    linked = components(links(nodes.select("fingerprint"), bits)).withColumnRenamed("node", "fingerprint")
    rooted = nodes.join(linked, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    chosen = stored(rooted.groupBy("root").agg(F.min("least").alias("least")), "chosen")
    chosen = chosen.select(*[F.col(f"least.{k}").alias(n) for k, n in zip(keys, names)])
    kept = row_key(docs, names).join(chosen, names, "left_semi")
    return kept.dropDuplicates(names).select(*[column(kept, c) for c in docs.columns])
