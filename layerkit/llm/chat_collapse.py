"""Chat formatting with cumulative snapshots collapsed, in DataFrame operations.

A conversation logged after every turn leaves each of its prefixes in the log. A turn hashes its place,
role and text; the exclusive or of the hashes so far is the rolling hash of a prefix, and two of
them make 128 bits. A conversation is dropped if its whole is a prefix of a longer one: an
anti-join of wholes against proper prefixes, both reduced to distinct rows before they are shuffled.
Equal conversations are one class, whose smallest id stays. Only the turns of kept conversations are
rendered.

Places come from two levels: turns are numbered within blocks of consecutive turn numbers, and
blocks are counted up per conversation. So the longest conversation is no single sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerkit.llm.common import column, stored

#: Turn numbers per block, and turns per rendered row.
BLOCK = 1024
PART = 256


def _xor(names: list[str]) -> list:
    return [F.bit_xor(n).alias(n) for n in names]


def _turns(log: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct turns with null roles `unknown`, null texts empty, and marks in texts broken up."""
    rows = log.select(
        column(log, conv_id).alias("conv_id"), column(log, turn).alias("turn"),
        F.coalesce(column(log, role).cast("string"), F.lit("unknown")).alias("role"),
        F.replace(F.coalesce(column(log, text).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"),
    )
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK).cast("bigint"))
    for k in (1, 2):
        rows = rows.withColumn(f"said{k}", F.xxhash64(F.lit(k), "role", "text"))
    return rows


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, hash1, hash2, last): the rolling hash up to each distinct turn, `place`
    counted from 1, and whether it is the whole conversation."""
    distinct = turns.groupBy("conv_id", "block", "turn", "said1", "said2").agg(F.count("*").alias("times"))
    inner = Window.partitionBy("conv_id", "block").orderBy(
        F.col("turn").asc_nulls_first(), "said1", "said2"
    )
    distinct = distinct.withColumn("within", F.row_number().over(inner))
    blocks = distinct.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first())
    blocks = blocks.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"),
        F.coalesce(F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("all"),
    )
    same = distinct["conv_id"].eqNullSafe(blocks["c"]) & distinct["block"].eqNullSafe(blocks["b"])
    placed = distinct.join(blocks, same).drop("c", "b")
    placed = placed.withColumn("place", F.col("before") + F.col("within"))
    for k in (1, 2):
        placed = placed.withColumn(f"step{k}", F.xxhash64(F.lit(k), "place", f"said{k}"))
    placed = stored(placed, "turns")
    sums = placed.groupBy("conv_id", "block").agg(*_xor(["step1", "step2"]))
    sums = sums.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"),
        *[
            F.coalesce(
                F.bit_xor(f"step{k}").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias(f"base{k}")
            for k in (1, 2)
        ],
    )
    same = placed["conv_id"].eqNullSafe(sums["c"]) & placed["block"].eqNullSafe(sums["b"])
    rolling = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.join(sums, same)
    return joined.select(
        "conv_id", "turn", "said1", "said2", "place", (F.col("place") == F.col("all")).alias("last"),
        *[F.bit_xor(f"step{k}").over(rolling).bitwiseXOR(F.col(f"base{k}")).alias(f"hash{k}") for k in (1, 2)],
    )


def maximal(rolled: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_same): of each class of equal conversations that no longer one
    starts with, the smallest id and the number of members."""
    state = ["place", "hash1", "hash2"]
    wholes = rolled.where("last").groupBy(*state).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_same"))
    inner = rolled.where("not last").select(*state).distinct()
    kept = wholes.join(inner, state, "left_anti")
    return kept.select("conv_id", F.col("place").alias("n_turns"), "n_same")


def collapse(
    log: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per kept conversation and part: `conv_id`, `part`, `n_turns`, `n_same`,
    `chat`. The parts of a conversation, `PART` turns each, make up its rendered text in order.

    Turns go by number, nulls first, then by content; repeated rows are one turn; different turns of
    one number all count. A null role reads `unknown`, a null text is empty. Null ids are one
    conversation, which gives way to an equal one with an id. An empty log gives no rows.
    """
    turns = _turns(log, conv_id, turn, role, text)
    rolled = stored(prefixes(turns), "prefixes")
    kept = maximal(rolled).select(F.col("conv_id").alias("kept_id"), "n_turns", "n_same")
    places = rolled.join(kept, rolled["conv_id"].eqNullSafe(kept["kept_id"])).select(
        F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("said1").alias("s1"), F.col("said2").alias("s2"),
        "place", "n_turns", "n_same",
    )
    once = turns.select("conv_id", "turn", "said1", "said2", "role", "text").dropDuplicates(
        ["conv_id", "turn", "said1", "said2"]
    )
    same = (
        once["conv_id"].eqNullSafe(places["c"]) & once["turn"].eqNullSafe(places["t"])
        & (once["said1"] == places["s1"]) & (once["said2"] == places["s2"])
    )
    said = once.join(places, same)
    line = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    part = F.floor((F.col("place") - 1) / PART).cast("bigint")
    parts = said.groupBy("conv_id", part.alias("part"), "n_turns", "n_same").agg(
        F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("lines")
    )
    chat = F.array_join(F.transform("lines", lambda x: x["line"]), "")
    return parts.select("conv_id", "part", "n_turns", "n_same", chat.alias("chat"))
