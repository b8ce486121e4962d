"""Ledger of processed files, and the list of files still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.operators.tables import latest
from citeflow.sources.records import NameRule, phase_of, plain_path


def list_files(spark: SparkSession, data_dir: str, name: NameRule) -> DataFrame:
    """Gzip files below a folder: path, length, file, phase. Reads no content."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.gz")
        .load(data_dir)
    )
    file = name(plain_path())
    return listed.select("path", "length", file.alias("file"), phase_of(file).alias("phase"))


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose relative name is not in the ledger, in the order they apply."""
    done = ledger.select(F.col("fn").alias("file")).distinct()
    return files.join(done, "file", "left_anti").orderBy("phase", "file")


def queued_counts(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed and pending record files by phase; other file types do not count."""
    done = ledger.select(F.col("fn").alias("file"), F.lit(1).alias("_done")).distinct()
    named = files.where(F.col("file").endswith("xml.gz")).join(done, "file", "left")
    return named.groupBy("phase").agg(
        F.count("*").alias("listed"), F.count_if(F.col("_done").isNull()).alias("queued")
    )


def file_key(fn: Column) -> Column:
    return F.sha2(fn, 256)


def ledger_rows(stats: DataFrame) -> DataFrame:
    """Ledger rows of file statistics (file, article_cnt, duration)."""
    return stats.select(
        file_key(F.col("file")).alias("file_key"),
        F.col("file").alias("fn"),
        F.col("article_cnt").cast("bigint").alias("article_cnt"),
        F.col("duration").cast("double").alias("duration"),
    )


def ledger_current(rows: DataFrame, run: str = "run") -> DataFrame:
    """Last entry per file: a file processed again replaces its row."""
    return latest(rows, "file_key", [run]).drop(run)


def ledger_files(ledger: DataFrame) -> DataFrame:
    return ledger.select("fn")
