"""Quality selection by importance resampling.

Two bag-of-n-grams models over hashed word uni- and bigrams, one counted over all texts, one over
the texts labelled good, give every text the log ratio of its probabilities. With a Gumbel variate
added, the texts of the largest keys are a sample without replacement in proportion to the ratios.

The ratio of a whole text grows with its length, and with it the variate counts for less. On demand
a text longer than a given number of n-grams counts as one of that length with the same mean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import column, stored, text_slices
from layerkit.llm.words import WORDPUNCT, chained, places, sums, word_hashes

BUCKETS = 10_000
_DIGIT = 16


def hashed_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, words per text, buckets of all pairs of neighbours, pairs per text."""
    words, counts = word_hashes([t.lower() for t in texts], WORDPUNCT)
    inside = np.flatnonzero(places(counts) > 0)
    pairs = chained(words[inside - 1], words[inside])
    size = np.uint64(BUCKETS)
    return (words % size).astype(np.int64), counts, (pairs % size).astype(np.int64), np.maximum(counts - 1, 0)


def count_grams(docs: DataFrame, good: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """n-grams per bucket over all `docs` (doc_id, text) and over those with an id in `good`
    (distinct `good_id`). Tasks count into arrays; their sums meet by bucket, and the driver
    gets one row per bucket. The ids grow with the corpus, so the join is by shuffle at every size."""
    named = docs.join(good.hint("merge"), docs["doc_id"] == good["good_id"], "left")
    named = named.select("text", F.col("good_id").isNotNull().alias("good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            chosen = batch.column(1).to_numpy(zero_copy_only=False)
            for start, run in text_slices(batch.column(0)):
                words, n_words, pairs, n_pairs = hashed_grams(run)
                own = chosen[start : start + len(run)]
                for grams, each in ((words, n_words), (pairs, n_pairs)):
                    total[0] += np.bincount(grams, minlength=BUCKETS)
                    total[1] += np.bincount(grams[np.repeat(own, each)], minlength=BUCKETS)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], names=["bucket", "raw", "target"]
        )

    counted = named.mapInArrow(count, "bucket bigint, raw bigint, target bigint")
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the two models per bucket, each count raised by one."""
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def _ordered(keys: np.ndarray) -> np.ndarray:
    """Integers in the order of the numbers."""
    bits = keys.view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def weigh(docs: DataFrame, ratios: np.ndarray, seed: int, reference: int | None = None) -> DataFrame:
    """(doc_id, n_grams, log_weight, key, place) of every one of `docs` (doc_id, text); `place`
    has the order of `key`."""
    mark = F.xxhash64(F.lit(seed), "doc_id", F.col("text").isNull(), "text")
    rows = docs.select("doc_id", "text", mark.alias("mark"))
    schema = rows.select(
        "doc_id", F.lit(0).cast("bigint").alias("n_grams"), F.lit(0.0).alias("log_weight"),
        F.lit(0.0).alias("key"), F.lit(0).cast("bigint").alias("place"),
    ).schema

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, run in text_slices(batch.column(1)):
                words, n_words, pairs, n_pairs = hashed_grams(run)
                n = n_words + n_pairs
                weight = sums(ratios[words], n_words) + sums(ratios[pairs], n_pairs)
                if reference is not None:
                    weight *= reference / np.maximum(n, reference)
                part = batch.slice(start, len(run))
                mark = part.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
                chance = ((mark >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
                key = weight - np.log(-np.log(chance)) + 0.0
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.array(weight), pa.array(key), pa.array(_ordered(key))],
                    names=schema.names,
                )

    return rows.mapInArrow(compute, schema)


def place_of(rows: DataFrame, rank: int) -> int | None:
    """The `place` of the row that is `rank`-th from the top, counted from 1: four counts by 16
    bits each, from the upper ones down, find it without sorting or gathering rows."""
    if rank < 1:
        return None
    prefix, left, rows = 0, rank, rows.select("place")
    for step in range(64 // _DIGIT):
        shift = 64 - _DIGIT * (step + 1)
        digit = F.shiftright("place", shift)
        # at most 2^16 groups share the upper bits found so far
        within = rows if not step else rows.where(F.shiftright("place", shift + _DIGIT) == prefix)
        counts = sorted(within.groupBy(digit.alias("digit")).count().collect(), reverse=True)
        for value, n in counts:
            if left <= n:
                prefix = value
                break
            left -= n
        else:
            return None
    return prefix


def resample(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id",
    quality: str = "quality", share: float | None = None, seed: int = 0, reference: int | None = None,
) -> DataFrame:
    """One row per document: `doc_id`, `n_grams`, `log_weight`, `key`, `kept`. The `share` of all
    documents with the largest keys is kept, and whatever ties with the last of them; without a
    given one, the share of quality 1 among the labels, or all documents if there are none.

    `log_weight` is the log ratio of the whole text; with `reference`, that of a longer text is
    scaled to so many n-grams. A document is a target if any label of its id has quality 1. Null texts have no n-grams and
    weight 0. Repeated rows have equal keys and stay or go together. Without targets the target
    model is uniform; without documents there are no rows.
    """
    rows = docs.select(column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"))
    good = labels.where(column(labels, quality) == 1).select(column(labels, label_id).alias("good_id"))
    good = good.where("good_id is not null").distinct()
    if share is None:
        mean = labels.agg(F.avg((column(labels, quality) == 1).cast("double"))).first()[0]
        share = 1.0 if mean is None else mean
    ratios = log_ratios(*count_grams(rows, good))
    weighed = stored(weigh(rows, ratios, seed, reference), "weights")
    last = place_of(weighed, round(share * weighed.count()))
    kept = F.lit(False) if last is None else F.col("place") >= last
    return weighed.select("doc_id", "n_grams", "log_weight", "key", kept.alias("kept"))
