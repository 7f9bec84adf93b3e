"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import alignment, bpe, language, merkle, mixing, phrases, quality, repeats, secret_scan, simhash, toxicity, unigram, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, distance=4)


@_query("op2_document_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.edited_fingerprints(_table(spark, sf_dir, "documents"))


@_query("op3_bpe_round_trip")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(spark, _table(spark, sf_dir, "documents"), path)


@_query("op4_quality_rules", quality.quality_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents")).drop("broken")


@_query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op6_source_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op7_warc", warc.SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, _table(spark, sf_dir, "pages"))


@_query("op8_secret_scan", secret_scan.report_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(_table(spark, sf_dir, "documents"))


@_query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.document_languages(_table(spark, sf_dir, "documents"))


@_query("pages_language_id")
def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.fit(_table(spark, sf_dir, "documents"))
    return language.page_languages(_table(spark, sf_dir, "pages"), model)


@_query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return unigram.token_counts(_table(spark, sf_dir, "documents"), path)


@_query("op11_merkle_manifest", merkle.manifest_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(_table(spark, sf_dir, "documents"))


@_query("op12_cross_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    byte_path, piece_path = paths
    docs = _table(spark, sf_dir, "documents")
    return alignment.digests(alignment.aligned_documents(docs, byte_path, public_tokenizers.PATTERN, piece_path))


@_query("op13_suffix_array_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_report(repeats.without_repeats(_table(spark, sf_dir, "documents")))
