"""Mixing sources to target weights by capped water-filling, with DataFrame operations only.

1. Sources in code-point order (null last) get the weights in turn; each is to give its share of
   the total size.
2. A source gives at most ``max_epochs`` times its size. What it cannot give is shared among the
   others by weight until none is above its cap: the level at which the water stands rises in
   rounds, each one aggregate over the table of sources.
3. The target of a source is a number of whole repetitions of all its documents and a fraction.
   For the fraction its documents are taken in the order of a seeded hash up to the document
   that comes nearest to the target. The cut is found digit by digit: sums per source and hash
   bucket, then within the bucket where the cut lies, so a source with a third of all documents
   is never sorted or gathered in one task.

Defined results: a null text has size 0, as an empty one; an empty table or one without words
gives targets of 0; rows that agree in id and text share a hash and are one unit, taken
together; the null source is a source. The result has the input's columns and ``size``,
``source_size``, ``target``, ``copies`` and ``taken``, which replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow.llm.graph import stored

ADDED = ("size", "source_size", "target", "copies", "taken")
HASH_BITS = 60
DIGIT_BITS = 12
LEVELS = 2


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def seeded_hash(seed: int, doc_id: Column, text: Column) -> Column:
    """60 bits of an MD5 over seed, id and text."""
    joined = F.concat(
        F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"),
        F.coalesce(text, F.lit("")),
    )
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _ranked(sources: DataFrame, spark: SparkSession) -> DataFrame:
    """``rank`` from 0 in code-point order, null last: ranges are sorted apart and counted."""
    ordered = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(
        F.col("source").asc_nulls_last()
    )
    placed = stored(ordered.withColumn("place", F.monotonically_increasing_id()), spark, "sources")
    part = F.shiftright("place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(  # one row per partition of the table of sources
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )
    return placed.withColumn("part", part).join(before, "part").select(
        "source", "source_size", (F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("rank")
    )


def _level(sources: DataFrame, max_epochs: int) -> float:
    """Units of size to a unit of weight such that the capped shares give the total."""
    cap = F.col("source_size") * max_epochs
    level, clamped = 0.0, -1
    while True:
        over = (F.col("weight") * F.lit(level) > cap) if clamped >= 0 else F.lit(False)
        row = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(over, cap).otherwise(0)).alias("given"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("open"),
            F.count(F.when(over, 1)).alias("clamped"),
        ).first()
        if row.clamped == clamped or not row.open:
            return level
        level, clamped = (row.total - row.given) / row.open, row.clamped


def targets(
    docs: DataFrame, source: str = "source", weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3,
) -> DataFrame:
    """``source, source_size, target`` from rows with a source and a ``size``; stored."""
    spark = docs.sparkSession
    summed = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(
        F.sum("size").alias("source_size")
    )
    nth = " ".join(f"WHEN {i} THEN {w}L" for i, w in enumerate(weights))
    weighed = stored(
        _ranked(summed, spark).withColumn("weight", F.expr(f"CASE rank % {len(weights)} {nth} END")),
        spark, "weights",
    )
    share = F.col("weight") * F.lit(_level(weighed, max_epochs))
    cap = (F.col("source_size") * max_epochs).cast("double")
    return weighed.select("source", "source_size", F.least(share, cap).alias("target"))


def _cuts(keyed: DataFrame, wanted: DataFrame, spark: SparkSession) -> DataFrame:
    """``source, cut``: documents of the source with ``h <= cut`` are in the fraction."""
    rest, left = wanted.where("need > 0"), keyed
    for k in range(LEVELS + 1):
        shift = HASH_BITS - DIGIT_BITS * (k + 1)
        bucket = F.shiftright("h", shift) if k < LEVELS else F.col("h")
        sums = left.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("n"))
        inside = sums.where("n > 0").join(rest, sums["source"].eqNullSafe(rest["source"])).select(
            sums["source"], "bucket", "n", "need",
            F.sum("n").over(
                Window.partitionBy(sums["source"]).orderBy("bucket")
            ).alias("upto"),
        )
        edge = inside.where("upto >= need AND upto - n < need")
        if k == LEVELS:
            nearer = F.expr("upto - need <= need - (upto - n)")
            return edge.select(
                "source", F.when(nearer, F.col("bucket")).otherwise(F.col("bucket") - 1).alias("cut")
            )
        rest = stored(
            edge.select("source", "bucket", F.expr("need - (upto - n)").alias("need")), spark, "edge"
        )
        at = rest.select(F.col("source").alias("at_source"), F.col("bucket").alias("at_bucket"))
        left = left.join(
            at, left["source"].eqNullSafe(at["at_source"]) & (bucket == at["at_bucket"]), "left_semi"
        )
        rest = rest.select("source", "need")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: int = 7,
) -> DataFrame:
    """Every row with what the mix takes of it; see the module's text.

    The table of sources is written below the shared folder, as are ids, sizes and hashes of the
    documents; texts are not moved.
    """
    spark = docs.sparkSession
    body, key = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    size, h = text_size(body), seeded_hash(seed, key, body)
    keyed = stored(
        docs.select(F.col(f"`{source}`").alias("source"), size.alias("size"), h.alias("h")),
        spark, "mix",
    )
    per_source = targets(keyed, "source", weights, max_epochs).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0),
    ).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    cuts = _cuts(keyed, per_source.select("source", "need"), spark)
    plan = stored(
        per_source.join(cuts, per_source["source"].eqNullSafe(cuts["source"]), "left").select(
            per_source["source"].alias("_mix_source"), F.struct(
                "source_size", "target", "whole", F.coalesce("cut", F.lit(-1)).alias("cut")
            ).alias("_mix_plan"),
        ),
        spark, "mixplan",
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED]
    placed = docs.select(*kept, F.struct(
        size.alias("size"), h.alias("h"), F.col(f"`{source}`").alias("source")).alias("_mix_key"))
    joined = placed.join(plan, placed["_mix_key.source"].eqNullSafe(plan["_mix_source"]))
    more = F.when(F.col("_mix_key.h") <= F.col("_mix_plan.cut"), 1).otherwise(0)
    copies = (F.col("_mix_plan.whole") + more).cast("long")
    return joined.select(
        *kept, F.col("_mix_key.size").alias("size"), F.col("_mix_plan.source_size").alias("source_size"),
        F.col("_mix_plan.target").alias("target"), copies.alias("copies"),
        (copies * F.col("_mix_key.size")).alias("taken"),
    )


def mixed_rows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns it came with."""
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{doc_id}`").alias("id"),
        F.col(f"`{text}`").alias("text"), F.col(f"`{source}`").alias("source"),
    )
    times = F.array_repeat(F.lit(0), F.col("copies").cast("int"))
    return mix(whole, "id", "text", "source", **options).select("row", F.explode(times)).select("row.*")
