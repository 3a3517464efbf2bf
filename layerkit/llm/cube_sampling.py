"""Mixing sources to target weights by balanced sampling with the cube method.

A source whose target is r times its size gives every document floor(r) whole copies and one more
with inclusion probability r - floor(r). The cube method draws these: while three undecided
documents are at hand there is a direction in the null space of the two balancing constraints
(documents and tokens), along which their probabilities move until one of them is 0 or 1. Totals stay
as they are. Blocks of documents do this side by side, each leaving two undecided at most; those
meet in the next round's blocks. A source's last block lands: its documents are decided from the largest on,
all smaller ones making up for it. The constraint on documents is given up where both cannot be kept, that
on tokens for the smallest ones left.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerkit.llm.common import WORD, column, row_key, stored, unused

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
MOST = 2.0
#: Documents a block holds on average.
BLOCK = 4096
_NEAR = 1e-9


def _direction(a: float, b: float, c: float) -> tuple[float, float, float]:
    """A direction that keeps the number and the tokens of three documents."""
    if a == b == c:
        return 1.0, -1.0, 0.0
    return b - c, c - a, a - b


def _moved(held: list, u: Sequence[float], rng: random.Random) -> None:
    """Move the probabilities of `held` along or against u until one is 0 or 1. The two ends are
    drawn so that each probability is its own mean."""
    up = min((1 - p) / d if d > 0 else p / -d for (p, _, _), d in zip(held, u) if d)
    down = min(p / d if d > 0 else (1 - p) / -d for (p, _, _), d in zip(held, u) if d)
    step = up if rng.random() * (up + down) < down else -down
    for unit, d in zip(held, u):
        p = unit[0] + step * d
        unit[0] = 0.0 if p < _NEAR else 1.0 if p > 1 - _NEAR else p


def flight(chances: Sequence[float], sizes: Sequence[float], rng: random.Random) -> list[float]:
    """Probabilities after the flight, at most two of them undecided."""
    result = list(chances)
    held: list[list] = []

    def retire() -> None:
        for unit in held:
            result[unit[2]] = unit[0]
        held[:] = [u for u in held if 0 < u[0] < 1]

    for i, (p, size) in enumerate(zip(chances, sizes)):
        if not 0 < p < 1:
            continue
        held.append([p, size, i])
        if len(held) == 3:
            _moved(held, _direction(*[s for _, s, _ in held]), rng)
            retire()
    if len(held) == 2 and held[0][1] == held[1][1]:
        _moved(held, (1.0, -1.0), rng)
        retire()
    return result


def _against(p: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Directions that move the first of the documents up and the smaller ones the other way by the room
    they have: both constraints kept; the tokens kept, larger ones moving more; the tokens kept, all
    alike. None if the smaller ones have no word to make up for the first one's."""
    room, first, rest = (p * (1 - p))[1:], sizes[0], sizes[1:]
    n, words, squares = room.sum(), (room * rest).sum(), (room * rest * rest).sum()
    both = n * squares - words * words
    if len(rest) > 2 and both > 1e-9 * n * squares:
        yield np.append(1.0, room * ((first * words - squares) + (words - first * n) * rest) / both)
    if words > 0:
        yield np.append(1.0, -first * room * rest / squares)
        yield np.append(1.0, -first * room / words)
    elif first == 0 and n > 0:
        yield np.append(1.0, -room / n)


def _reaches(p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far every probability can move along `u` and against it."""
    with np.errstate(divide="ignore", invalid="ignore"):
        to_one, to_zero = (1 - p) / np.abs(u), p / np.abs(u)
    return (
        np.where(u > 0, to_one, np.where(u < 0, to_zero, np.inf)),
        np.where(u > 0, to_zero, np.where(u < 0, to_one, np.inf)),
    )


def landing(chances: Sequence[float], sizes: Sequence[float], rng: random.Random) -> list[float]:
    """Probabilities after the last block, each 0 or 1. The largest undecided document goes first, along
    the first direction that decides it; if none does, along the last one. So the tokens are off by what
    small documents have, and their number only where both cannot be kept."""
    p, words = np.array(chances, float), np.array(sizes, float)
    left = np.argsort(-words, kind="stable")
    left = left[(p[left] > 0) & (p[left] < 1)]
    while len(left):
        own, u = p[left], None
        for u in _against(own, words[left]):
            ups, downs = _reaches(own, u)
            if ups[0] <= ups.min() and downs[0] <= downs.min():
                break
        if u is None:
            p[left[0]], left = float(rng.random() < own[0]), left[1:]
            continue
        rises = rng.random() * (ups.min() + downs.min()) < downs.min()
        reach = ups if rises else downs
        moved = own + (reach.min() if rises else -reach.min()) * u
        # the one that sets the step is at its end whatever the rounding
        at = reach.argmin()
        moved[at] = float((u[at] > 0) == rises)
        moved = np.where(moved < _NEAR, 0.0, np.where(moved > 1 - _NEAR, 1.0, moved))
        p[left], left = moved, left[(moved > 0) & (moved < 1)]
    return p.tolist()


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources by code point, null last, weigh `WEIGHTS` in turn and share `TOTAL` times all sizes. A
    target stops at `MOST` times its source's size, and what is over is shared by weight among the
    others. Filling up to a common level does that at once: the sources whose cap is lowest for
    their weight are full, the others get the level times their weight. The windows go over
    one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1
    rows = totals.select(
        "*",
        F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), turn).alias("weight"),
        (F.lit(MOST) * F.col("source_size")).alias("cap"),
    )
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    rows = rows.select(
        "*",
        F.row_number().over(by_cap).alias("place"),
        F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)).alias("full"),
        F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("open"),
        (F.lit(TOTAL) * F.sum("source_size").over(every)).alias("share"),
    )
    level = (F.col("share") - F.coalesce("full", F.lit(0.0))) / F.col("open")
    rows = rows.withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    rows = rows.withColumn("level", F.first("level", True).over(every.orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("level") * F.col("weight"))
    )
    return rows.select("source", "source_size", target.alias("target"))


def draw(units: DataFrame, keys: Sequence[str], seed: int = 0, block: int = BLOCK) -> DataFrame:
    """`units` (`keys`, source, size, chance) with `chance` 0 or 1 after the cube method, rows in
    any order. `keys` tell units apart; equal ones are interchangeable. The blocks follow from the
    keys alone, so a rerun or a repeated task draws the same."""
    schema = units.schema
    order = [*keys, "size"]

    def flying(turn: int):
        def fly(key: tuple, table: pa.Table) -> pa.Table:
            source, number, blocks = [k.as_py() for k in key]
            rng = random.Random(f"{seed}|{source!r}|{turn}|{number}")
            table = table.sort_by([(c, "ascending") for c in ["_order", *order]]).select(schema.names)
            decide = landing if blocks == 1 else flight
            chances = decide(table["chance"].to_pylist(), table["size"].to_pylist(), rng)
            at = schema.names.index("chance")
            return table.set_column(at, "chance", pa.array(chances, pa.float64()))

        return fly

    undecided = (F.col("chance") > 0) & (F.col("chance") < 1)
    units = stored(units, "units")
    done, pending, turn = [units.where(~undecided)], units.where(undecided), 0
    while not pending.isEmpty():
        counts = pending.groupBy("source").agg(F.count("*").alias("n"))
        counts = counts.select(
            F.col("source").alias("_source"), F.ceil(F.col("n") / block).cast("bigint").alias("_blocks")
        )
        spread = pending.join(counts, pending["source"].eqNullSafe(counts["_source"])).drop("_source")
        mark = F.xxhash64(F.lit(seed), F.lit(turn), *order)
        spread = spread.select("*", mark.alias("_order"), F.pmod(mark, F.col("_blocks")).alias("_block"))
        flown = spread.groupBy("source", "_block", "_blocks").applyInArrow(flying(turn), schema)
        flown = stored(flown, "flight")
        done.append(flown.where(~undecided))
        pending, turn = flown.where(undecided), turn + 1
    return reduce(DataFrame.union, done)


def _copies(rows: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """One row per document (`keys`, source, size, source_size, target, copies) from the stored
    rows (`keys`, source, size)."""
    targets = stored(source_targets(rows), "targets")
    joined = targets.withColumnRenamed("source", "_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # repeated rows are one row here and get a number each; that a hot row is many of them
    # costs the writer of this stage a loop, and no memory
    alike = rows.groupBy(*keys, "source", "size").agg(F.count("*").alias("_n"))
    units = alike.select("*", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy")).drop("_n")
    units = units.join(joined, units["source"].eqNullSafe(joined["_source"])).drop("_source")
    units = units.select(
        *keys, "_copy", "source", "size", "source_size", "target",
        F.floor(ratio).alias("_whole"), (ratio - F.floor(ratio)).alias("chance"),
    )
    drawn = draw(units, [*keys, "_copy"], seed)
    return drawn.withColumn("copies", (F.col("_whole") + F.col("chance")).cast("bigint"))


def words_of(text) -> F.Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """One row per document: `doc_id`, `size` (words), `source_size`, `target` (its source's),
    `taken` (words the mix takes, repeats counted) and `copies`.

    Null texts have no words; null sources are one source, the last. Repeated rows are documents of
    their own. A source without words has target 0. An empty table gives no rows. A source's total is
    off its target by less than its largest document; the more documents it has, the less.
    """
    rows = docs.select(
        column(docs, doc_id).alias("doc_id"), column(docs, source).alias("source"),
        words_of(column(docs, text)).alias("size"),
    )
    drawn = _copies(stored(rows, "sizes"), ["doc_id"], seed)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return drawn.select("doc_id", "size", "source_size", "target", taken, "copies")


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """The mix itself: rows of `docs`, each as often as it is taken, columns as they are."""
    names = unused([*docs.columns, "source", "size", "copies", "chance"], "_key1", "_key2", "_copies")
    keyed = row_key(docs, names[:2])
    rows = keyed.select(
        *[F.col(n) for n in names[:2]], column(docs, source).alias("source"),
        words_of(column(docs, text)).alias("size"),
    )
    drawn = _copies(stored(rows, "sizes"), names[:2], seed)
    times = drawn.groupBy(*names[:2]).agg(F.sum("copies").alias(names[2])).where(F.col(names[2]) > 0)
    # a repeated row is one row with the copies of all
    taken = row_key(docs, names[:2]).join(times, names[:2]).dropDuplicates(names[:2])
    repeated = taken.withColumn(names[2], F.explode(F.sequence(F.lit(1), F.col(names[2]))))
    return repeated.select(*[column(repeated, c) for c in docs.columns])


