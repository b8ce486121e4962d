"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.plans.workspace import new_dir


def stored(rows: DataFrame, spark: SparkSession, purpose: str) -> DataFrame:
    """Written below the shared folder and read again: lineage ends there."""
    path = new_dir(spark, purpose)
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest of u and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u")
    moved = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    mix = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mix)).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the edges ``a, b``; the root is the smallest node.

    Each round is written to the shared folder. Only a count and a checksum reach the driver.
    Minima are combined before the shuffle; a node with very many edges is split by skew joins.
    """
    spark = edges.sparkSession
    star = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    star = stored(star, spark, "edges")
    before = _state(star)
    while before[0]:
        star = stored(_small_star(_large_star(star).distinct()).distinct(), spark, "edges")
        now = _state(star)
        if now == before:
            break
        before = now
    roots = star.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return star.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
