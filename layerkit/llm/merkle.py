"""Merkle manifest of a dataset: a digest per row, a tree per group, a tree over the groups' roots.

Rows of a group in order are the leaves of its tree. They are dealt into blocks of FANOUT^BLOCK_LEVELS
consecutive leaves, and a task hashes a block up to its top. The rest is a butterfly exchange: in
every round aligned groups of FANOUT blocks, which differ in one digit of their number, swap the roots
of the subtrees they have so far, and each hashes the ancestor for itself. After the last round every
block holds the root and all siblings on its way there; nothing has to come down again. The roots of
the groups are leaves of another tree, whose paths are found the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm.common import column, stored
from layerkit.session import few_rows

FANOUT = 16
#: Levels of a tree that one task hashes: 256 leaves to a block.
BLOCK_LEVELS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: A run of siblings without the node itself: the digests left and right of it.
_STEP = "struct<before:string,after:string>"
_PATH = f"array<{_STEP}>"


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values one after another, each `-` if null, else its UTF-8 length, `:` and the
    value itself, so that no two rows of values are written alike."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def path_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, from the leaf to the root and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _levels(leaves: int, fanout: int) -> int:
    """Levels above so many leaves."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // fanout), levels + 1
    return levels


def _placed(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """`rows` with `place`, counted from 0 within `tree`, and `of`, the rows of that tree.

    Rows are sorted by range partitions and numbered where they are; a partition begins with what
    earlier ones hold of the tree it begins with. One line per partition comes to the driver.
    """
    spark = rows.sparkSession
    rows = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "leaves")
    ordered = rows.orderBy(F.col("tree").asc_nulls_first(), *order, "_at").drop("_at")
    layout = T.StructType([
        *ordered.schema.fields, T.StructField("_part", T.LongType()), T.StructField("_run", T.LongType()), T.StructField("_in_run", T.LongType()),
    ])
    tree_at = ordered.columns.index("tree")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, inside, last, begun = TaskContext.get().partitionId(), 0, 0, None, False
        for batch in batches:
            runs, insides = [], []
            for tree in batch.column(tree_at).to_pylist():
                if begun and tree != last:
                    run, inside = run + 1, 0
                last, begun = tree, True
                runs.append(run)
                insides.append(inside)
                inside += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(runs), pa.int64()), pa.array(runs, pa.int64()), pa.array(insides, pa.int64())],
                names=layout.names,
            )

    numbered = stored(ordered.mapInArrow(number, layout), "numbered")
    # per partition: the runs it has, what its first and its last run hold, and whose they are
    ends = numbered.groupBy("_part").agg(
        F.max("_run").alias("runs"),
        F.count_if(F.col("_run") == 0).alias("first_n"),
        F.max_by(F.struct("tree", "_in_run"), F.struct("_run", "_in_run")).alias("last"),
        F.first(F.when(F.col("_run") == 0, F.struct("tree")), ignorenulls=True).alias("first"),
    ).orderBy("_part").collect()
    starts, held, whose = [], 0, None
    for line in ends:
        if whose is None or line["first"]["tree"] != whose[0]:
            held = 0
        starts.append((line["_part"], held))
        held = held + line["first_n"] if line["runs"] == 0 else line["last"]["_in_run"] + 1
        whose = (line["last"]["tree"],)
    starts = few_rows(spark, starts, "_part bigint, _before bigint")
    place = F.when(F.col("_run") == 0, F.col("_before")).otherwise(0) + F.col("_in_run")
    return numbered.join(F.broadcast(starts), "_part").select(*rows.drop("_at").columns, place.cast("bigint").alias("place"))


def _hashed(digests: Sequence[str], levels: int, fanout: int) -> list[list[str]]:
    """The nodes of every level, leaves first."""
    nodes = [list(digests)]
    for _ in range(levels):
        below = nodes[-1]
        nodes.append([
            hashlib.sha256("".join(below[i : i + fanout]).encode()).hexdigest() for i in range(0, len(below), fanout)
        ])
    return nodes


def _steps(nodes: list[list[str]], fanout: int, place: int) -> list[tuple[str, str]]:
    """What stands left and right of the way up from a leaf."""
    path = []
    for level in nodes[:-1]:
        run = place // fanout * fanout
        path.append(("".join(level[run:place]), "".join(level[place + 1 : run + fanout])))
        place //= fanout
    return path


def _exchanged(tops: DataFrame, rounds: int, fanout: int) -> DataFrame:
    """`tops` (tree_none, tree, block, blocks, node) with `node` raised to the root of its tree and
    `path`, the siblings met on the way."""
    state = tops.withColumn("path", F.array().cast(_PATH))
    for r in range(rounds):
        span = F.lit(fanout**r)
        low = F.col("block") % span
        digit = F.floor(F.col("block") / span) % fanout
        high = F.floor(F.col("block") / (span * fanout))
        # blocks below this node: the last one of a tree may have fewer than `span`
        size = F.least(span, F.col("blocks") - F.floor(F.col("block") / span) * span)
        rising = F.col("blocks") > span
        # a partner stands at the same place of another node; where that has none, one of its others stands in
        ends = F.when(digit > 0, span - 1).otherwise(low)
        sent = state.where(rising).select(
            "*", low.alias("_low"), digit.alias("_digit"), high.alias("_high"),
            F.explode(F.sequence(low, F.greatest(low, ends), F.greatest(size, F.lit(1)))).alias("_to"),
        )
        own = F.struct("block", "blocks", "_digit", "path")
        met = sent.groupBy("tree_none", "tree", "_high", "_to").agg(
            F.sort_array(F.collect_list(F.struct("_digit", "node"))).alias("nodes"),
            F.collect_list(F.when(F.col("_to") == F.col("_low"), own)).alias("members"),
        )
        each = met.select("tree_none", "tree", "nodes", F.explode("members").alias("m"))

        def joined(wanted) -> Column:
            found = F.filter("nodes", wanted) if wanted else F.col("nodes")
            return F.array_join(F.transform(found, lambda n: n["node"]), "")

        step = F.struct(
            joined(lambda n: n["_digit"] < F.col("m._digit")).alias("before"),
            joined(lambda n: n["_digit"] > F.col("m._digit")).alias("after"),
        )
        raised = each.select(
            "tree_none", "tree", "m.block", "m.blocks", F.sha2(joined(None), 256).alias("node"),
            F.concat("m.path", F.array(step)).cast(_PATH).alias("path"),
        )
        state = stored(state.where(~rising).unionByName(raised), "exchange")
    return state


def paths(leaves: DataFrame, order: Sequence[Column], fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """`leaves` (tree, leaf and any others) with `path`, the siblings on the way to the root of its
    tree, and `node`, that root. Leaves of a tree stand in `order`, nulls as it says; rows equal in it
    stand in any order, so it should end with what tells them apart."""
    size = fanout**block_levels
    placed = _placed(leaves, order)
    keyed = placed.select(
        F.col("tree").isNull().alias("tree_none"), F.coalesce("tree", F.lit("")).alias("tree"),
        F.floor(F.col("place") / size).cast("bigint").alias("block"), *[c for c in placed.columns if c != "tree"],
    )
    keys = ["tree_none", "tree", "block"]
    tops_schema = "tree_none boolean, tree string, block bigint, n bigint, tops array<string>"

    def top(table: pa.Table) -> pa.Table:
        rows = table.select(["place", "leaf"]).sort_by("place")
        nodes = _hashed(rows["leaf"].to_pylist(), block_levels, fanout)
        first = table.slice(0, 1).select(keys).to_pylist()[0]
        # a lone block stops as soon as one node remains
        return pa.Table.from_pylist(
            [first | {"n": len(table), "tops": [level[0] for level in nodes]}], schema=tops_layout
        )

    tops_layout = pa.schema([
        ("tree_none", pa.bool_()), ("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("tops", pa.list_(pa.string())),
    ])
    tops = stored(keyed.select(*keys, "place", "leaf").groupBy(*keys).applyInArrow(top, tops_schema), "tops")
    sizes = tops.groupBy("tree_none", "tree").agg(F.count("*").alias("blocks"), F.sum("n").alias("of"))
    tops = tops.join(sizes, ["tree_none", "tree"])
    own_levels = F.lit(block_levels)
    for levels in reversed(range(block_levels)):
        own_levels = F.when(F.col("of") <= fanout**levels, levels).otherwise(own_levels)
    tops = tops.select(*keys, "blocks", F.get("tops", own_levels).alias("node"), own_levels.alias("levels"))
    tops = stored(tops, "subtrees")
    most = tops.agg(F.max("blocks")).first()[0] or 0
    upper = _exchanged(tops.drop("levels"), _levels(most, fanout), fanout)
    upper = upper.join(tops.select(*keys, "levels"), keys).select(*keys, "levels", "node", F.col("path").alias("upper"))
    # names that rows of any kind have not
    carried = [f for f in keyed.schema.fields if f.name not in keys]
    spelled = T.StructType([
        T.StructField("tree_none", T.BooleanType()), T.StructField("tree", T.StringType()), *carried,
        T.StructField("inner", T.ArrayType(T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())]))),
        T.StructField("upper", upper.schema["upper"].dataType), T.StructField("node", T.StringType()),
    ])

    def climb(table: pa.Table, above: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        levels = above["levels"][0].as_py()
        nodes = _hashed(table["leaf"].to_pylist(), levels, fanout)
        inner = [[{"before": b, "after": a} for b, a in _steps(nodes, fanout, i)] for i in range(len(table))]
        step = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        again = pa.array([0] * len(table), pa.int64())
        return pa.table(
            [table[c] for c in ("tree_none", "tree")] + [table[f.name] for f in carried]
            + [pa.array(inner, step), above["upper"].cast(step).take(again), above["node"].take(again)],
            names=spelled.names,
        )

    climbed = keyed.groupBy(*keys).cogroup(upper.groupBy(*keys)).applyInArrow(climb, spelled)
    tree = F.when(~F.col("tree_none"), F.col("tree")).alias("tree")
    return climbed.select(
        tree, *[f.name for f in carried if f.name != "place"], "place", F.concat("inner", "upper").cast(_PATH).alias("path"), "node"
    )


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", order: str = "doc_id",
    also: dict[str, Column] | None = None, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per row of `docs`: `item` (its `order` column), `tree` (its group as text), `place` in the group, `leaf`,
    `subroot` of the group, `root`, `path` (the siblings left and right, level by level up to the
    root), and the columns of `also`.

    Leaves stand by `order`, null first, then by their digest; groups by their UTF-8 bytes, null first.
    Runs of `fanout` nodes become one node until one remains; a lone leaf is its own subroot, a lone
    group's subroot the root. Repeated rows are leaves of their own. Other columns are not read. An
    empty table gives no rows.
    """
    also = also or {}
    rows = docs.select(
        column(docs, group).cast("string").alias("tree"), column(docs, order).alias("item"),
        leaf_digest([column(docs, f) for f in fields]).alias("leaf"), *[c.alias(n) for n, c in also.items()],
    )
    ordered = [F.col("item").asc_nulls_first(), F.col("leaf"), *[F.col(n).asc_nulls_first() for n in also]]
    inside = stored(paths(rows, ordered, fanout, block_levels).withColumnRenamed("node", "subroot"), "paths")
    roots = inside.where("place = 0").select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("subroot").alias("leaf"))
    tops = paths(roots, [F.col("group").asc_nulls_first()], fanout, block_levels)
    tops = stored(tops.select(F.col("group"), F.col("path").alias("above"), F.col("node").alias("root")), "roots")
    joined = inside.join(tops, inside["tree"].eqNullSafe(tops["group"]))
    return joined.select(
        "item", "tree", "place", "leaf", "subroot", "root", F.concat("path", "above").cast(_PATH).alias("path"), *also
    )
