"""The operators of this subpackage applied to the given tables, with SQL where it can say the same."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm import (
    backoff_lm,
    chat_collapse,
    contextual_pii,
    cube_sampling,
    decontaminate,
    importance_resampling,
    language_id,
    merkle,
    packed_ids,
    quotient_filter,
    secret_forest,
    simhash,
    spelling,
)

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(VOCABULARY))


def chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat_collapse.collapse(_table(spark, sf, "conversations"))


def language(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return language_id.predict(docs, language_id.train(docs))


def exact(spark: SparkSession, sf: str) -> DataFrame:
    return quotient_filter.exact_duplicates(_table(spark, sf, "documents"))


def mixing(spark: SparkSession, sf: str) -> DataFrame:
    return cube_sampling.mix(_table(spark, sf, "documents"))


def token_ids(spark: SparkSession, sf: str) -> DataFrame:
    return packed_ids.token_files(_table(spark, sf, "documents"), tokenizer_file())


def quality(spark: SparkSession, sf: str) -> DataFrame:
    return importance_resampling.resample(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf, "documents"))


def decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return backoff_lm.score(_table(spark, sf, "documents"))


def secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_forest.findings(_table(spark, sf, "documents"))


#: One run in so many loses a letter: misspellings known to be there.
DROPPED = 97


def spellings(spark: SparkSession, sf: str) -> DataFrame:
    runs = spelling.runs(_table(spark, sf, "documents"), dropped=DROPPED)
    return spelling.variants(spelling.vocabulary(runs))


def personal(spark: SparkSession, sf: str) -> DataFrame:
    found = contextual_pii.personal_data(_table(spark, sf, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, F.lit(k)))).cast("bigint").alias(f"n_{name}")
        for k, name in enumerate(contextual_pii.KINDS)
    ]
    every = F.sort_array(F.concat("base", "learned"))
    return found.select(
        "doc_id", *counts, F.sha2(contextual_pii.written(F.col("base")), 256).alias("base_sha256"),
        contextual_pii.written(every).alias("spans"), F.size("learned").cast("bigint").alias("n_learned"),
    )


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Every row's path in the manifest, and what a tampered copy of a fifth of them folds to."""
    docs = _table(spark, sf, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    values = [lowered if f == "text" else F.col(f) for f in merkle.FIELDS]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.manifest(docs, also={"tampered": F.when(chosen, merkle.leaf_digest(values))})
    fold = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    found = found.select(
        F.col("item").alias("doc_id"), "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"),
        fold.alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_chat_collapse": chat,
    "op2_language_id": language,
    "op3_exact_dedup": exact,
    "op4_mixing": mixing,
    "op5_token_ids": token_ids,
    "op6_importance_resampling": quality,
    "op7_simhash_dedup": near_duplicates,
    "op8_decontamination": decontamination,
    "op9_backoff_lm": lm_scores,
    "op10_secret_scan": secrets,
    "op11_spelling_variants": spellings,
    "op12_contextual_pii": personal,
    "op13_merkle_manifest": manifest,
}

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {
    "op1_chat_collapse": """
      WITH said AS (
        SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role,
               replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
      placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
               count(*) OVER (PARTITION BY conv_id) AS n_turns,
               '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS line
        FROM said),
      rolled AS (
        SELECT *, string_agg(line, '' ORDER BY place) OVER (
          PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS upto FROM placed),
      wholes AS (
        SELECT min(conv_id) AS conv_id, count(*) AS n_same, n_turns, upto FROM rolled
        WHERE place = n_turns GROUP BY n_turns, upto),
      kept AS (
        SELECT * FROM wholes w WHERE NOT EXISTS (
          SELECT 1 FROM rolled r WHERE r.place < r.n_turns AND r.place = w.n_turns AND r.upto = w.upto))
      SELECT k.conv_id, CAST(floor((p.place - 1) / 256) AS BIGINT) AS part, k.n_turns, k.n_same,
             string_agg(p.line, '' ORDER BY p.place) AS chat
      FROM kept k JOIN placed p ON p.conv_id = k.conv_id
      GROUP BY ALL
    """,
    "op3_exact_dedup": f"""
      WITH texts AS (SELECT doc_id, {_LOWER} AS text FROM documents)
      SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
             row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) = 1 AS kept,
             sha256(text) AS text_sha256
      FROM texts WINDOW same AS (PARTITION BY text)
    """,
    "op8_decontamination": rf"""
      WITH items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
      windows AS (
        SELECT DISTINCT item_id, words[i : i + least(len(words), 13) - 1] AS w
        FROM (SELECT item_id, words, unnest(range(1, len(words) - least(len(words), 13) + 2)) AS i
              FROM items WHERE len(words) > 0)),
      docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
      sizes AS (SELECT DISTINCT len(w) AS size FROM windows),
      places AS (
        SELECT doc_id, size, i, words[i : i + size - 1] AS w
        FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, sizes)),
      hits AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (w)),
      words_hit AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
      items_hit AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
      SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
             sha256(coalesce(ids, '')) AS items_sha256,
             coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
      FROM docs LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
    """,
}
