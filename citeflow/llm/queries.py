"""One query per operator, over the whole of its table; names and columns are fixed."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from citeflow.llm import (
    collocations, decontaminate, license_scan, mixture, ngram_lm, quality_classifier, quality_rules, repeats,
    resample,
    secret_scan, simhash, token_files, warc,
)
from citeflow.plans.workspace import new_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    return decontaminate.report(docs, benchmark)


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality_rules.apply_rules(docs, keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixture.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs)


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    shards = token_files.write(docs, new_dir(spark, "tokens"), TOKENIZER)
    return token_files.read_checksums(shards)


@query
def op5_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(_read(spark, sf_dir, "pages"), new_dir(spark, "warc"))
    return warc.read(archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_read(spark, sf_dir, "documents"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_read(spark, sf_dir, "documents"))


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@query
def op10_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(_read(spark, sf_dir, "documents"), min_count=1)


@query
def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    return resample.resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_read(spark, sf_dir, "documents")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query
def op12_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
