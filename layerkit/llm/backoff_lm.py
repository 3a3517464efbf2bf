"""Stupid-backoff language-model scores from n-gram tables partitioned by hash.

Texts are gathered into chunks. A chunk's distinct n-grams, with their counts there, are exploded into
blocks by their length and equal ranges of their hash; blocks of the same range meet in one task,
which holds one partition of the count table for every length. The table's counts are joined back to every
block and so to its chunk, where scores are summed per document. What is shuffled are packed runs of
sorted hashes and counts, not rows per n-gram; a frequent n-gram is one entry per chunk.

Tasks grow in number with the corpus, so that none grows. A chunk is never cut into more than `FAN` blocks of
a length at once: beyond as many partitions, blocks of a wider range are merged by teams of chunks first, and
the merged ones are cut further, level by level. Blocks thus number chunks times `FAN` per level, and
not chunks times partitions. Counts return the same way, through the teams to the chunks.

A document is scored by what the other documents say: its own occurrences are taken off all
counts. Otherwise every n-gram would have been seen and nothing would back off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import WORD, column, utf8
from layerkit.llm.words import chained, places, sums, word_hashes

ORDER = 3
BACKOFF = 0.4
#: Bytes of text in a chunk.
CHUNK = 12 << 20
#: Words whose n-grams one task counts on average, and so the n-grams of a length in a partition of the count table.
PARTITION = 1 << 22
#: Ranges of hashes a block is cut into at once, and blocks that a team merges on average.
FAN = 1 << 12
_CHUNKS = "chunk bigint, ids binary, texts binary"
_BLOCKS = "part bigint, chunk bigint, grams binary, counts binary"
_REPLIES = "chunk bigint, part bigint, counts binary"


def _squeezed(values: np.ndarray) -> bytes:
    """Unsigned integers byte plane by byte plane, compressed; high planes of small numbers vanish."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _sorted_bytes(values: np.ndarray) -> bytes:
    return _squeezed(np.diff(values, prepend=np.uint64(0)))


def _from_sorted_bytes(data: bytes) -> np.ndarray:
    return np.cumsum(_unsqueezed(data), dtype=np.uint64)


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words per text, and for every length 1 to `order` the hashes of all n-grams of the texts
    and the places, counted over all texts, of the words that end them."""
    words, counts = word_hashes([t.lower() for t in texts])
    place = places(counts)
    hashes, ends = [words], [np.arange(len(words))]
    for n in range(2, order + 1):
        end = np.flatnonzero(place >= n - 1)
        # of all runs one shorter, which are there for every later place
        before = np.zeros(len(words), np.uint64)
        before[ends[-1]] = hashes[-1]
        hashes.append(chained(before[end - 1], words[end]))
        ends.append(end)
    return counts, hashes, ends


def _packed(ids: pa.Array, texts: list[bytes]) -> tuple[bytes, bytes]:
    batch = pa.RecordBatch.from_arrays([ids], names=["doc_id"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    data = np.array([len(t) for t in texts], "<u8").tobytes() + b"".join(texts)
    return sink.getvalue().to_pybytes(), zstandard.ZstdCompressor(level=3).compress(data)


def _unpacked(texts: bytes, n: int) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(texts)
    ends = np.cumsum(np.frombuffer(data, "<u8", n).astype(np.int64)) + 8 * n
    return [data[a:b] for a, b in zip([8 * n, *ends[:-1]], ends)]


def _ids(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_all().column(0).combine_chunks()


def chunks(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """`docs` (doc_id, text) in rows of about `size` bytes of text."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        texts: list[bytes] = []
        held = 0
        for batch in batches:
            start = 0
            for i in range(len(batch)):
                value = utf8(batch.column(1).slice(i, 1))[0]
                texts.append(value)
                held += len(value)
                if held >= size:
                    ids.append(batch.column(0).slice(start, i + 1 - start))
                    yield row(number, ids, texts)
                    number, ids, texts, held, start = number + 1, [], [], 0, i + 1
            ids.append(batch.column(0).slice(start))
        if texts:
            yield row(number, ids, texts)

    def row(number: int, ids: list[pa.Array], texts: list[bytes]) -> pa.RecordBatch:
        packed = _packed(pa.concat_arrays(ids), texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([packed[0]], pa.binary()), pa.array([packed[1]], pa.binary())],
            names=["chunk", "ids", "texts"],
        )

    return docs.mapInArrow(gather, _CHUNKS)


def _spread(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows dealt by their chunk: the first chunks of all partitions one after the other, then the second ones."""
    slot = F.expr(f"cast(pmod((chunk >> 32) + (chunk & 4294967295) * 2654435761, {tasks}) as int)")
    return rows.withColumn("slot", slot).repartitionById(tasks, "slot")


def _ranges(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which of `parts` equal ranges each hash is in; ranges of a multiple of `parts` lie within these."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _cut(chunk: int, n: int, values: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """A block for every range that sorted n-grams of a length fall in."""
    part = _ranges(values, parts)
    edges = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(values))
    for a, b in zip(edges[:-1], edges[1:]) if len(values) else ():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([n * parts + part[a]], pa.int64()), pa.array([chunk], pa.int64()),
                pa.array([_sorted_bytes(values[a:b])], pa.binary()), pa.array([_squeezed(counts[a:b])], pa.binary()),
            ],
            names=["part", "chunk", "grams", "counts"],
        )


def _blocks(gathered: DataFrame, order: int, parts: int) -> DataFrame:
    """Rows (part, chunk, grams, counts); a part is the n-gram's length times `parts`, and the range of its hash."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                _, hashes, _ = grams(_unpacked(r["texts"], len(_ids(r["ids"]))), order)
                for n in range(order):
                    yield from _cut(r["chunk"], n, *np.unique(hashes[n], return_counts=True), parts)

    return gathered.mapInArrow(explode, _BLOCKS)


def _grams(blocks: pa.Table) -> list[np.ndarray]:
    return [_from_sorted_bytes(g.as_py()) for g in blocks["grams"]]


def _summed(blocks: pa.Table, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all blocks, sorted, and their counts."""
    values = np.concatenate(grams)
    counts = np.concatenate([_unsqueezed(c.as_py()) for c in blocks["counts"]])
    order = np.argsort(values, kind="stable")
    values = values[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], np.add.reduceat(counts[order], first)


def _replied(blocks: pa.Table, grams: list[np.ndarray], values: np.ndarray, total: np.ndarray) -> pa.Table:
    replies = [_squeezed(total[np.searchsorted(values, g)]) for g in grams]
    return pa.table({"chunk": blocks["chunk"], "part": blocks["part"], "counts": pa.array(replies, pa.binary())})


def _counted(blocks: pa.Table) -> pa.Table:
    """One partition of the count table joined to the blocks asking for it."""
    grams = _grams(blocks)
    return _replied(blocks, grams, *_summed(blocks, grams))


def _answers(asked: DataFrame, chunks: int, fan: int, parts: int, partitions: int) -> DataFrame:
    """Replies to blocks cut into `parts` ranges by about `chunks` askers, `partitions` being the
    ranges to count in: at once, or merged by teams and cut `fan` times finer."""
    if parts >= partitions:
        # every task gets the same number of ranges of each length
        dealt = asked.withColumn("slot", F.pmod("part", F.lit(partitions)).cast("int"))
        return dealt.repartitionById(partitions, "slot").groupBy("slot", "part").applyInArrow(_counted, _REPLIES)
    teams = -(-chunks // fan)
    asked = asked.withColumn("team", F.pmod(F.xxhash64("chunk"), F.lit(teams))).repartition(partitions, "part", "team")

    def merged(blocks: pa.Table) -> pa.Table:
        n = blocks["part"][0].as_py() // parts
        return pa.Table.from_batches(
            list(_cut(blocks["team"][0].as_py(), n, *_summed(blocks, _grams(blocks)), parts * fan))
        )

    def returned(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        grams = _grams(blocks)
        known = [_unsqueezed(c.as_py()) for c in answers.sort_by("finer")["counts"]]
        return _replied(blocks, grams, np.unique(np.concatenate(grams)), np.concatenate(known))

    finer = asked.groupBy("part", "team").applyInArrow(merged, _BLOCKS)
    replies = _answers(finer, teams, fan, parts * fan, partitions).select(
        F.expr(f"part div {fan}").alias("part"), F.col("chunk").alias("team"), F.col("part").alias("finer"), "counts"
    )
    back = replies.repartition(partitions, "part", "team").groupBy("part", "team")
    return asked.groupBy("part", "team").cogroup(back).applyInArrow(returned, _REPLIES)


def _own(which: np.ndarray, owner: np.ndarray, several: int) -> np.ndarray:
    """How often each n-gram occurs in its own text."""
    _, at, n = np.unique(owner * several + which, return_inverse=True, return_counts=True)
    return n[at]


def log_scores(texts: list[bytes], seen, total: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and summed log score of each text. `seen(n, hashes)` gives the counts of distinct
    n-grams, in ascending order of hash, in all texts; `total` is the number of all words. An
    unseen word counts as half an occurrence."""
    counts, hashes, ends = grams(texts, order)
    n_words = int(counts.sum())
    if not n_words:
        return counts, np.zeros(len(counts))
    owner = np.repeat(np.arange(len(texts)), counts)
    below = score = np.zeros(n_words)
    for n in range(order):
        values, which = np.unique(hashes[n], return_inverse=True)
        hashes[n] = None
        others = seen(n, values)[which] - _own(which, owner[ends[n]], len(values))
        here = np.zeros(n_words, np.int64)
        here[ends[n]] = others
        if n == 0:
            rest = np.maximum(total - counts, 1)[owner]
            score = np.log(np.where(here > 0, here, 0.5) / rest)
        else:
            score[ends[n]] += np.log(BACKOFF)
            known = ends[n][others > 0]
            score[known] = np.log(here[known] / below[known - 1])
        below = here
    return counts, sums(score, counts)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """One row per document: `doc_id`, `n_words`, `log_score` (summed over its words) and `mean_log`.

    Words are lower-cased (A-Z) runs between white space. Null texts and texts without words
    have log score 0 and a null mean. Copies of a text are other documents and make it likely.
    Ids may repeat or be null. An empty table gives no rows.
    """
    rows = docs.select(column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"))
    size = rows.agg(
        F.coalesce(F.sum(F.regexp_count("text", F.lit(WORD)).cast("bigint")), F.lit(0)).alias("words"),
        F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0)).alias("bytes"),
    ).first()
    volume = size["words"]
    several = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), volume // PARTITION)
    levels = 1
    while FAN**levels < several:
        levels += 1
    fan = several if levels == 1 else math.ceil(several ** (1 / levels))
    partitions = fan**levels
    gathered = _spread(chunks(rows), several)
    asked = _blocks(gathered, order, fan)
    replies = _answers(asked, max(1, size["bytes"] // CHUNK), fan, fan, partitions)
    schema = rows.select(
        "doc_id", F.lit(0).cast("bigint").alias("n_words"), F.lit(0.0).alias("log_score"),
        F.lit(None).cast("double").alias("mean_log"),
    ).schema

    def summed(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        kept = []
        answers = answers.sort_by("part")
        length = answers["part"].to_numpy() // fan

        def seen(n: int, values: np.ndarray) -> np.ndarray:
            own = answers["counts"].filter(pa.array(length == n))
            known = [_unsqueezed(c.as_py()).astype(np.int64) for c in own]
            if sum(map(len, known)) != len(values):
                raise ValueError("counts of other n-grams than the chunk's")
            return np.concatenate(known) if known else np.zeros(0, np.int64)

        for r in chunk.to_pylist():
            ids = _ids(r["ids"])
            counts, total = log_scores(_unpacked(r["texts"], len(ids)), seen, volume, order)
            mean = np.divide(total, counts, out=np.zeros(len(counts)), where=counts > 0)
            kept.append(pa.table([ids, pa.array(counts), pa.array(total), pa.array(mean, mask=counts == 0)], schema.names))
        return pa.concat_tables(kept) if kept else pa.table([[]] * 4, schema.names)

    answered = gathered.groupBy("slot", "chunk").cogroup(_spread(replies, several).groupBy("slot", "chunk"))
    return answered.applyInArrow(summed, schema)
