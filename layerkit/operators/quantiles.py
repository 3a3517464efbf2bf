"""Exact quantiles of whole columns, without sorting them or gathering them in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000


@dataclass
class _Rank:
    """Search for the value at 0-based `rank` of `column`: it lies strictly between `low` and
    `high` (None = open), where `inside` values lie and `before` values precede them."""

    column: str
    rank: int
    inside: int
    before: int = 0
    low: float | None = None
    high: float | None = None
    guesses: tuple = ()
    value: float | None = None

    @property
    def interval(self) -> tuple:
        return self.column, self.low, self.high

    def shares(self, accuracy: int) -> list[float]:
        """Shares of the interval between which a sketch of it should put the rank: twice the
        sketch's error to either side."""
        slack = 2 * self.inside // accuracy
        k = self.rank - self.before + 1
        return [(max(1, k - slack) - 0.5) / self.inside, (min(self.inside, k + slack) - 0.5) / self.inside]

    def narrow(self, counts: dict) -> None:
        """`counts` tells for each guess how many values are less and how many at most equal."""
        after = self.before + self.inside
        for guess in self.guesses:
            less, upto = counts[guess]
            if less <= self.rank < upto:
                self.value = guess
                return
            if self.before <= upto <= self.rank:
                self.low, self.before = guess, upto
            elif self.rank < less <= after:
                self.high, after = guess, less
        if after - self.before == self.inside:
            raise ArithmeticError(f"no value found at rank {self.rank} of {self.column}")
        self.inside = after - self.before


def _inside(column: str, low, high) -> Column:
    x = F.col(column)
    ok = x.isNotNull()
    if low is not None:
        ok = ok & (x > F.lit(low))
    if high is not None:
        ok = ok & (x < F.lit(high))
    return ok


def _propose(df: DataFrame, ranks: Sequence[_Rank], accuracy: int) -> None:
    """Set the guesses of all ranks: one sketch per interval, shared by the ranks in it."""
    groups: dict[tuple, list[_Rank]] = {}
    for r in ranks:
        groups.setdefault(r.interval, []).append(r)
    sketches = []
    for interval, group in groups.items():
        shares = [p for r in group for p in r.shares(accuracy)]
        value = F.when(_inside(*interval), F.col(interval[0]))
        sketches.append(F.percentile_approx(value, shares, accuracy))
    wanted = reduce(lambda a, b: a | b, [_inside(*interval) for interval in groups])
    found = df.where(wanted).agg(*[s.alias(f"g{i}") for i, s in enumerate(sketches)]).first()
    for i, group in enumerate(groups.values()):
        for j, r in enumerate(group):
            r.guesses = tuple(dict.fromkeys((found[f"g{i}"] or [])[2 * j : 2 * j + 2]))


def _count(df: DataFrame, guesses: dict[str, list]) -> dict[str, dict]:
    """For every guess of every column (less, at most equal). Each value is sent to the gap
    between guesses, or the guess, it falls on, and these few places are counted."""
    places = []
    for column, values in guesses.items():
        x = F.col(column)
        steps = [(x >= F.lit(g)).cast("int") + (x > F.lit(g)).cast("int") for g in values]
        places.append(reduce(lambda a, b: a + b, steps))
    cells = df.select(F.posexplode(F.array(*places)).alias("which", "place")).where("place is not null")
    found = {(r["which"], r["place"]): r["count"] for r in cells.groupBy("which", "place").count().collect()}
    counts: dict[str, dict] = {}
    for which, (column, values) in enumerate(guesses.items()):
        counts[column], seen = {}, 0
        for i, g in enumerate(values):
            less = seen + found.get((which, 2 * i), 0)
            seen = less + found.get((which, 2 * i + 1), 0)
            counts[column][g] = (less, seen)
    return counts


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = ACCURACY,
) -> dict[str, dict[float, float | None]]:
    """Linearly interpolated quantiles per column, NULLs ignored. NaN comes last: a rank that falls
    on one has the quantile NaN.

    Each round is two aggregates for all columns together: a bounded sketch of the values still
    in question proposes a narrow interval per wanted rank, and a count over the whole table
    confirms it or moves the search to the side the rank is on. A round shrinks the interval
    some hundredfold, so even 10^12 rows take four or five.
    """
    real = [F.when(~F.isnan(c), F.col(c)).alias(c) for c in columns]
    counts = df.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.count_if(F.isnan(c)).alias(f"nan{i}") for i, c in enumerate(columns)],
    ).first()
    sizes = {c: counts[f"n{i}"] for i, c in enumerate(columns)}
    reals = {c: sizes[c] - counts[f"nan{i}"] for i, c in enumerate(columns)}
    df = df.select(*real)
    ranks: dict[tuple, _Rank] = {}
    for c in columns:
        for p in probabilities if sizes[c] else ():
            position = p * (sizes[c] - 1)
            for rank in (math.floor(position), math.ceil(position)):
                last = math.nan if rank >= reals[c] else None
                ranks.setdefault((c, rank), _Rank(c, rank, reals[c], value=last))
    pending = [r for r in ranks.values() if r.value is None]
    while pending:
        _propose(df, pending, accuracy)
        guesses: dict[str, set] = {}
        for r in pending:
            guesses.setdefault(r.column, set()).update(r.guesses)
        counts = _count(df, {c: sorted(g) for c, g in guesses.items() if g})
        for r in pending:
            r.narrow(counts.get(r.column, {}))
        pending = [r for r in pending if r.value is None]

    result: dict[str, dict[float, float | None]] = {}
    for c in columns:
        result[c] = dict.fromkeys(probabilities)
        for p in probabilities if sizes[c] else ():
            position = p * (sizes[c] - 1)
            low, high = (float(ranks[c, f(position)].value) for f in (math.floor, math.ceil))
            share = position - math.floor(position)
            result[c][p] = low + (high - low) * share if share else low
    return result
