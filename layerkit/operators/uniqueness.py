"""Repeated keys of tables whose keys are nearly all different.

Counting keys by groups shuffles a row per key, and of unique keys none is combined before. Here the
first pass packs the hashes of keys into sorted runs, a row per run, and finds the hashes that occur
more than once; only the keys that have one of those are grouped and counted. Different keys of one hash
are told apart by that count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.operators.joins import BROADCAST_BYTES
from layerkit.session import store

#: Hashes that a task holds before it packs them, and that one part has on average.
RUN = 1 << 22
PART = 1 << 22
#: What a hash costs in a broadcast relation.
_BROADCAST_ROW = 64
_RUNS = "part bigint, hashes binary"


def packed_hashes(df: DataFrame, keys: Sequence[str], parts: int, run: int = RUN) -> DataFrame:
    """Rows (part, hashes): sorted 64-bit hashes of the keys of up to `run` rows, cut by their upper
    bits into `parts`, a power of two. A hash is in a run at most twice, which tells that it repeats."""
    bits = parts.bit_length() - 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            n += len(held[-1])
            if n >= run:
                yield cut(np.concatenate(held))
                held, n = [], 0
        if n:
            yield cut(np.concatenate(held))

    def cut(values: np.ndarray) -> pa.RecordBatch:
        values.sort()
        twice = np.ones(len(values), bool)
        twice[2:] = values[2:] != values[:-2]
        values = values[twice]
        part = (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        hashes = [values[a:b].astype("<u8").tobytes() for a, b in zip(starts, [*starts[1:], len(values)])]
        return pa.RecordBatch.from_arrays(
            [pa.array(part[starts]), pa.array(hashes, pa.binary())], names=["part", "hashes"]
        )

    return df.select(F.xxhash64(*keys)).mapInArrow(pack, _RUNS)


def _repeated(runs: pa.Table) -> pa.Table:
    values = np.concatenate([np.frombuffer(h.as_buffer(), "<u8") for h in runs["hashes"]])
    values.sort()
    found = np.unique(values[1:][values[1:] == values[:-1]])
    return pa.table({"key_hash": pa.array(found.view(np.int64))})


def repeated_hashes(df: DataFrame, keys: Sequence[str], run: int = RUN, part: int = PART) -> DataFrame:
    """`key_hash`: the hashes (`xxhash64`) of keys that more than one row has."""
    rows = df.count()
    parts = 1 << (max(1, -(-rows // part)) - 1).bit_length()
    return packed_hashes(df, keys, parts, run).groupBy("part").applyInArrow(_repeated, "key_hash bigint")


def repeated_keys(
    df: DataFrame,
    keys: Sequence[str],
    count_as: str = "count",
    broadcast_bytes: int = BROADCAST_BYTES,
    run: int = RUN,
    part: int = PART,
) -> DataFrame:
    """Keys that occur more than once, with their number of rows, NULL being one key.

    The first pass runs at once and stores the repeated hashes. If they are few enough to broadcast, only
    the keys that have one are shuffled; if not, most keys repeat, groups are combined before the
    shuffle, and all are counted.
    """
    keyed = df.select(*keys)
    found = store(repeated_hashes(keyed, keys, run, part), "repeated-hashes")
    if found.count() * _BROADCAST_ROW <= broadcast_bytes:
        # the count above bounds the broadcast
        keyed = keyed.join(F.broadcast(found), F.xxhash64(*[keyed[k] for k in keys]) == found["key_hash"], "left_semi")
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as))
    return counts.where(F.col(count_as) > 1)
