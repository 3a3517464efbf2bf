"""The corpus pipeline: documents to files of token ids, in five stages.

Every stage takes the documents its predecessor kept, written as Parquet and read again. The first
four return documents, the last what the files of ids hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerkit.llm import cube_sampling, decontaminate, language_id, packed_ids, simhash
from layerkit.llm.common import stored
from layerkit.llm.queries import tokenizer_file
from layerkit.session import ship_package


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    ship_package(spark)
    return language_id.accepted(docs, language_id.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship_package(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold benchmark items."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship_package(spark)
    return cube_sampling.mixed_documents(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the files of token ids hold, per document."""
    ship_package(spark)
    return packed_ids.token_files(docs, tokenizer_file())


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: Language models and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each stored before the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
