"""From documents to token files: five stages, each on all that the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of documents. ``run`` writes each stage's rows as Parquet below the shared folder and
reads them again, so a lost executor costs at most the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citeflow.llm import decontaminate, mixture, quality_rules, simhash, token_files
from citeflow.llm.queries import TOKENIZER
from citeflow.plans.workspace import new_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that with the smallest id.

    Operator 9 with its contract's figures: three-word shingles, at most three of 64 bits apart.
    """
    return simhash.keep_one(docs, shingle=simhash.SHINGLE)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without test items: spans are cut out, documents that are mostly such spans go."""
    return decontaminate.cleaned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixture.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows, read back: ``doc_id, start, n_tokens, ids_crc32`` of each."""
    return token_files.read_checksums(token_files.write(docs, new_dir(spark, "tokens"), TOKENIZER))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixing", mixed),
    ("token_files", tokens),
]

# XXH64 fingerprints and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
