"""From raw documents to token ids: five stages, each written before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import bpe, language, mixing, secret_scan, simhash
from pulsegrid.session import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, under the language they are in."""
    return language.identified_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.deduplicated(docs, shingle=4, distance=4)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    clean = secret_scan.redacted(docs)
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the fitted rates say."""
    return mixing.mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the text they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    # executors also hold what the stages before have left in their memory
    return bpe.round_trip(spark, docs, path, keep=("ids",), chunk=1 << 20, kept=50_000)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("mix", mix),
    ("encode", encode),
]

#: Hashes, components, fitted rates and merges are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
