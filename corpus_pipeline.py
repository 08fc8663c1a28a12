"""Corpus pipeline: from documents to token ids on disk.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before
it kept, and is written as Parquet and read again for the next.  All but the
last return the columns of ``documents``.

* language_id drops documents whose text has no language;
* near_dedup keeps one document of each group of near copies;
* decontaminate drops documents that hold a window of a benchmark item;
* mix takes documents as often as their source's target weight asks;
* token_ids writes the mix to files of ids and reports what the files hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsboard.llm import decontaminate, language, mixing, simhash, tokens
from newsboard.llm.common import landed


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.drop_undetermined(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs, mixing.mix_sources(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.read_ids(tokens.write_ids(docs)).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", drop_leaks),
    ("mix", mix),
    ("token_ids", token_ids),
]

#: The mix draws by Spark's hash and token ids need the tokenizer: the stages
#: are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
