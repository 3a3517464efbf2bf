"""The manifest against trees built plainly."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from layerkit.llm import merkle

LAYOUT = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in merkle.FIELDS])


def tree(leaves, fanout):
    """Root, and per leaf the (left, right) siblings of every level."""
    nodes, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = place // fanout * fanout
            paths[i].append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + fanout])))
            at[i] = place // fanout
        nodes = [digest(*nodes[a : a + fanout]) for a in range(0, len(nodes), fanout)]
    return nodes[0], paths


def plain(rows, fanout):
    """(doc_id, source, place, leaf, subroot, root, path) of every row."""
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row)))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s])], fanout) for s in sources}
    root, above = tree([trees[s][0] for s in sources], fanout)
    out = []
    for s, top in zip(sources, above):
        subroot, paths = trees[s]
        for place, ((known, doc_id, leaf), path) in enumerate(zip(sorted(groups[s]), paths)):
            out.append((doc_id if known else None, s, place, leaf, subroot, root, tuple(path + top)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(
        [(r.item, r.tree, r.place, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.path)) for r in df.collect()],
        key=repr,
    )


@pytest.mark.parametrize("fanout, levels", [(2, 1), (3, 2)])
def test_equals_plain_trees(spark, fanout, levels):
    rng = random.Random(fanout)
    # group sizes around powers of the fanout, so that last runs are short or single
    sizes = {None: 1, "": fanout, "a": 37, "ä": fanout**3, "b": fanout**4 + 1, "Z": 2, "c.d": fanout**2 + 1}
    rows = [(s, i) for s, n in sizes.items() for i in range(n)]
    rng.shuffle(rows)
    docs = [(k, s, rng.choice([None, "en"]), i, rng.choice([None, "", "ABC", "é" * i])) for k, (s, i) in enumerate(rows)]
    given = [dict(zip(merkle.FIELDS, (d[0], d[1], d[2], d[3], d[4]))) for d in docs]
    df = spark.createDataFrame(docs, LAYOUT).withColumn("place", F.lit("other")).withColumn("tree", F.lit(1)).repartition(5)
    got = merkle.manifest(df, fanout=fanout, block_levels=levels)
    assert rows_of(got) == plain(given, fanout)
    bad = got.where(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root"))
    assert bad.count() == 0


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    docs = [(None, "s", None, None, None)] * 9 + [(None, "s", "x", 1, "y"), (3, "s", None, 0, "")] + [(3, None, None, 2, "z" * 100_000)] * 3
    given = [dict(zip(merkle.FIELDS, d)) for d in docs]
    df = spark.createDataFrame(docs, LAYOUT)
    got = merkle.manifest(df, fanout=2, block_levels=1)
    assert rows_of(got) == plain(given, 2)
    assert merkle.manifest(df.limit(0)).count() == 0


def test_one_row(spark):
    got = merkle.manifest(spark.createDataFrame([(1, None, None, None, None)], LAYOUT)).first()
    assert got.leaf == got.subroot == got.root and got.path == []


def test_query_equals_plain_trees(spark, sf):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    by_id = {d["doc_id"]: d for d in docs}
    want = set()
    for doc_id, _, _, leaf, subroot, root, path in plain(docs, 16):
        node, text = leaf, by_id[doc_id]["text"]
        if zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
            node = leaf_of(by_id[doc_id] | {"text": "".join(c.lower() if "A" <= c <= "Z" else c for c in text)})
        for before, after in path:
            node = digest(before, node, after)
        want.add((doc_id, leaf, subroot, root, digest(*[b + a for b, a in path]), node, node == root))
    got = driver.queries()["op13_merkle_manifest"](spark, sf)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert {tuple(r) for r in got.collect()} == want
    assert {r[-1] for r in want} == {True, False}
