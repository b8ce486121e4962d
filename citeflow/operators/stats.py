"""Load statistics: counts and rates per file, in total and along the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeflow.schema import ARTICLE, BOOK


def file_counts(records: DataFrame) -> DataFrame:
    """Article and book records per file, files without any included."""
    counted = F.count_if(F.col("kind").isin(ARTICLE, BOOK))
    return records.groupBy("phase", "file").agg(counted.alias("article_cnt"))


def of_ledger(ledger: DataFrame) -> DataFrame:
    """The ledger of a store as the table of file statistics that the functions below take."""
    return ledger.select("phase", F.col("fn").alias("file"), "article_cnt", "duration", "elapsed")


def nonempty_files(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("article_cnt") > 0)


def _rate(count: Column, seconds: Column) -> Column:
    """NULL where no time passed."""
    return F.when(seconds != 0, count / seconds)


def file_rates(stats: DataFrame, workers: int) -> DataFrame:
    """Records per second of each file; for baseline files also the rate x workers estimate."""
    rate = _rate(F.col("article_cnt"), F.col("duration"))
    rated = stats.withColumn("rate", rate)
    return rated.withColumn("estimated_rate", F.when(F.col("phase") == 0, F.col("rate") * workers))


def total_rate(stats: DataFrame) -> DataFrame:
    """Records of all files over the time the last one was done at."""
    count = F.sum("article_cnt")
    return stats.agg(
        count.alias("article_cnt"), _rate(count, F.max("elapsed")).alias("total_rate")
    )


def progress_blocks(stats: DataFrame, every: int = 1000) -> DataFrame:
    """Count and rate at each ``every`` records of a phase, files taken in name order.

    Works on the per-file table alone: where a mark falls inside a file, the time is
    interpolated, so no record is ever numbered or moved. The running sums go over one row per
    file.
    """
    window = Window.partitionBy("phase").orderBy("file")
    through = F.sum("article_cnt").over(window)
    marked = stats.select(
        "phase", "file", "article_cnt", "duration",
        (through - F.col("article_cnt")).alias("before"),
        (F.sum("duration").over(window) - F.col("duration")).alias("time_before"),
    )
    first = F.floor(F.col("before") / every) + 1
    last = F.floor((F.col("before") + F.col("article_cnt")) / every)
    marks = F.when(last >= first, F.sequence(first, last))
    block = F.col("block")
    share = (block * every - F.col("before")) / F.col("article_cnt")
    elapsed = F.col("time_before") + share * F.col("duration")
    return marked.select("*", F.explode(marks).alias("block")).select(
        "phase", "block", "file",
        (block * every).alias("records"),
        elapsed.alias("elapsed"),
        _rate(block * every, elapsed).alias("rate"),
    )
