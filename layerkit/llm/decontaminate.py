"""Benchmark decontamination with a broadcast hash set of test n-grams, in DataFrame operations.

Every run of 13 words of a benchmark item is a window; a shorter item is one window as it stands. The
windows, once each, form a hash set that is broadcast if its measured size allows and joined by a
shuffle if not. Documents are scanned word by word: each word is hashed once, each place chains the hashes
of the words ahead and probes the set, and a hit counts once the words themselves are equal. Of what a shuffle moves, a row is a place
with the words ahead of it, never a whole text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import column, content_key, stored, unused

#: All but `[\x00-\x2F\x3A-\x60\x7B-\x7F]` of lowered text, said by what it is, which is matched four times as fast.
WORDS = r"[0-9a-z\x{80}-\x{10FFFF}]+"
WINDOW = 13
#: Windows are broadcast up to this measured size.
BROADCAST_BYTES = 64 << 20
#: One word in so many must be hit for a document to count as contaminated.
SHARE = 20


def lowered(text: Column) -> Column:
    """A-Z lowered, nothing else; null is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORDS), F.lit(0))


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """(hash, size, window, items): each window once, with the items it occurs in. Null texts and
    texts without words have none."""
    items = benchmark.select(
        F.coalesce(column(benchmark, item_id).cast("string"), F.lit("")).alias("item"),
        words_of(column(benchmark, text)).alias("words"),
    )
    size = F.least(F.size("words"), F.lit(width))
    each = items.where(F.size("words") > 0).select(
        "item", "words", size.alias("size"), F.explode(F.sequence(F.lit(1), F.size("words") - size + 1)).alias("at")
    )
    each = each.select("item", "size", F.slice("words", F.col("at"), F.col("size")).alias("window"))
    grouped = each.groupBy("size", "window").agg(F.collect_set("item").alias("items"))
    coded = grouped.withColumn("codes", _codes("window"))
    return coded.select(_chained(F.lit(0), width).alias("hash"), "size", "window", "items")


def _codes(words: str) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def _chained(at: Column, size: int) -> Column:
    """Hash of `size` words from place `at` on, taken from the words' own in `codes`, so that a word is read
    once whatever the number of windows over it. Places beyond the last word change nothing."""
    return F.xxhash64(*[F.get("codes", at + j) for j in range(size)])


def _probes(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """A row for each place and window size of each document (`keys`..., words), and a last one
    of null hash for the document itself."""
    several = len(sizes)
    rows = docs.withColumn("n_words", F.size("words").cast("bigint")).withColumn("codes", _codes("words"))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(0), F.size("words") * several)))
    at = F.floor(F.col("step") / several).cast("int") if several > 1 else F.col("step")
    size, chain = F.lit(sizes[0]), _chained(F.col("at"), sizes[0])
    for k, s in enumerate(sizes[1:], 1):
        turn = F.col("step") % several == k
        size, chain = F.when(turn, F.lit(s)).otherwise(size), F.when(turn, _chained(F.col("at"), s)).otherwise(chain)
    rows = rows.select("*", at.alias("at"), size.alias("reach"))
    fits = F.col("at") + F.col("reach") <= F.size("words")
    return rows.withColumn("probe", F.when(fits, chain))


def _ahead() -> Column:
    return F.slice("words", F.col("at") + 1, F.col("reach"))


def scan(
    docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str, item_id: str = "item_id",
    item_text: str = "text", width: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per distinct (`keys`, text) of `docs`: `keys`, two columns `text1` and `text2` that stand
    for the text, `copies` (rows of it), `n_words`, `spans` (place and size of hits) and `items`
    (items with windows that occur, sorted)."""
    found = stored(windows(benchmark, item_id, item_text, width), "windows")
    volume = F.sum(F.lit(64) + F.length(F.concat_ws(" ", "window")) + F.length(F.concat_ws(" ", "items")))
    facts = found.agg(F.collect_set("size").alias("sizes"), F.coalesce(volume, F.lit(0)).alias("bytes")).first()
    sizes = sorted(facts["sizes"]) or [width]  # at most `width` numbers
    value = column(docs, text)
    text1, text2 = content_key([value])
    rows = docs.select(
        *[column(docs, k).alias(k) for k in keys], text1.alias("text1"), text2.alias("text2"),
        words_of(value).alias("words"),
    )
    probes, facts_of = _probes(rows, sizes), [*keys, "text1", "text2", "n_words"]
    table = found.withColumnRenamed("size", "length")
    span = F.struct("at", F.col("length").alias("size"))
    if facts["bytes"] <= broadcast_bytes:
        hit = (F.col("probe") == F.col("hash")) & (F.col("window") == _ahead())
        own = F.col("step") == F.size("words") * len(sizes)
        met = probes.join(F.broadcast(table), hit, "left").where(own | F.col("hash").isNotNull()).select(
            *facts_of, own.cast("bigint").alias("own"), F.when(F.col("hash").isNotNull(), span).alias("span"), "items",
        )
    else:
        places = probes.where("probe is not null").select(*facts_of, "at", "probe", _ahead().alias("ahead"))
        hits = places.join(table, (F.col("probe") == F.col("hash")) & (F.col("window") == F.col("ahead")))
        hits = hits.select(*facts_of, F.lit(0).cast("bigint").alias("own"), span.alias("span"), "items")
        own = rows.select(
            *facts_of[:-1], F.size("words").cast("bigint").alias("n_words"), F.lit(1).cast("bigint").alias("own"),
            F.lit(None).cast(hits.schema["span"].dataType).alias("span"),
            F.lit(None).cast(hits.schema["items"].dataType).alias("items"),
        )
        met = own.union(hits)
    return met.groupBy(*keys, "text1", "text2").agg(
        F.sum("own").alias("copies"), F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def covered(spans: str = "spans") -> Column:
    """Number of words in a sorted array of spans, overlaps counted once."""
    start = F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).cast("bigint").alias("until"))

    def add(state: Column, span: Column) -> Column:
        end = (span["at"] + span["size"]).cast("bigint")
        fresh = F.greatest(F.lit(0).cast("bigint"), end - F.greatest(state["until"], span["at"].cast("bigint")))
        return F.struct((state["words"] + fresh).alias("words"), F.greatest(state["until"], end).alias("until"))

    return F.aggregate(spans, start, add, lambda s: s["words"])


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: `doc_id`, `n_words`, `n_hit` (words within occurring windows),
    `n_items`, `items_sha256` (of their sorted ids, comma-joined) and `contaminated`: a twentieth of the
    words or more is hit.

    Null texts have no words, as have texts of separators alone; both are clean. A null item id counts
    as the empty one. Repeated rows are judged once and returned as often as given. Without
    benchmark items every document is clean; without documents there are no rows.
    """
    named = docs.select(column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"))
    found = scan(named, benchmark, ["doc_id"], "text", item_id, item_text, broadcast_bytes=broadcast_bytes)
    found = found.withColumn("n_hit", covered())
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), _contaminated().alias("contaminated"),
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """`docs` without contaminated documents, columns as they are. The judgement is the text's, so
    texts are scanned once however often they occur."""
    found = scan(docs.select(column(docs, text).alias("text")), benchmark, [], "text", item_id, item_text)
    names = unused(docs.columns, "_text1", "_text2")
    dirty = found.withColumn("n_hit", covered()).where(_contaminated())
    dirty = dirty.select(F.col("text1").alias(names[0]), F.col("text2").alias(names[1]))
    text1, text2 = content_key([column(docs, text)])
    keyed = docs.select("*", text1.alias(names[0]), text2.alias(names[1]))
    left = keyed.join(dirty, names, "left_anti")
    return left.select(*[column(left, c) for c in docs.columns])


def without_spans(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """`docs` with the hit words cut out of their texts, each with the separators before it; the
    other columns and texts without a hit stay as they are."""
    found = scan(docs.select(column(docs, text).alias("text")), benchmark, [], "text", item_id, item_text)
    names = unused(docs.columns, "_text1", "_text2", "_spans")
    hits = found.where(F.size("spans") > 0).select(
        F.col("text1").alias(names[0]), F.col("text2").alias(names[1]), F.col("spans").alias(names[2])
    )
    value = column(docs, text)
    text1, text2 = content_key([value])
    keyed = docs.select("*", text1.alias(names[0]), text2.alias(names[1])).join(hits, names[:2], "left")
    upper = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    other = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    value = column(keyed, text)
    parts = F.regexp_extract_all(value, F.lit(f"({other}*{upper}+)"), F.lit(1))
    ending = F.regexp_extract(value, f"({other}*)$", 1)
    spans = F.col(names[2])
    kept = F.filter(parts, lambda _, i: ~F.exists(spans, lambda s: (s["at"] <= i) & (i < s["at"] + s["size"])))
    cut = F.when(spans.isNull(), value).otherwise(F.concat(F.array_join(kept, ""), ending))
    return keyed.select(*[cut.alias(c) if c == text else column(keyed, c) for c in docs.columns])
