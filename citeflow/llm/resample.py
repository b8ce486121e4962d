"""Importance resampling toward a target distribution, with an exact top-k by weighted selection.

1. Features are runs of ``ngram`` consecutive words (A-Z lower-cased); each falls into one of
   ``buckets`` hash buckets (unsigned CRC-32 of its UTF-8 bytes). Bucket counts of the corpus
   and of the target texts are two aggregates whose partial sums are combined before the shuffle,
   so a frequent word costs one row per task.
2. A bucket's gain is ``floor(1000 * ln((t+1)(S+B) / ((s+1)(T+B))))``: the log-ratio of the
   smoothed target and corpus shares. The table has ``buckets`` rows, a fixed bound, and is sent
   to the tasks whole; a document's weight is the sum of its features' gains, computed where the
   document lies.
3. A document's score adds Gumbel noise seeded by its id: ``floor(-1000 ln(-ln((h+0.5)/2^32)))``
   with ``h`` the first 32 bits of ``sha256("<seed>:<doc_id>")``. The ``floor(fraction * N)``
   highest scores among documents of at least ``min_words`` words are drawn.
4. The cut-off is found by weighted median-of-medians selection: each task reports the median
   and size of what is left of its partition, the driver takes the median of those medians
   weighted by the sizes, and one count tells on which side the wanted place lies. At least a
   quarter of what is left goes each round, and only one row per partition reaches the driver.
   The winners are then sorted by range and numbered by a prefix sum over partition counts.

Order is score descending, then doc_id ascending, then a row number fixed when scores are stored,
so repeated rows are drawn one by one, never half a tie.

Defined results: a null or empty text has no features (weight 0) and is not drawn; a null id
gets a null score and rank and is not counted among the N; repeated rows each get their own
row and rank; an empty table gives an empty table. Extra columns of ``docs`` are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeflow.llm.graph import stored

# Fixed values of the operator's contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NGRAM = 1
BUCKETS = 10000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = T.StructType([T.StructField("n", T.LongType()), T.StructField("score", T.DoubleType()),
                     T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType())])


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORD), 0)


def features(ws: Column, ngram: int = NGRAM) -> Column:
    """Runs of ``ngram`` words joined by one blank, in order, repeats kept."""
    if ngram == 1:
        return ws
    starts = F.sequence(F.lit(0), F.size(ws) - ngram)
    runs = F.transform(starts, lambda i: F.array_join(F.slice(ws, i + 1, ngram), " "))
    return F.when(F.size(ws) >= ngram, runs).otherwise(F.array().cast("array<string>"))


def bucket_of(feature: Column, buckets: int = BUCKETS) -> Column:
    return F.crc32(feature.cast("binary")) % buckets


def bucket_counts(texts: DataFrame, text: str = "text", ngram: int = NGRAM,
                  buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all features of all rows."""
    feats = texts.select(F.explode(features(words(F.col(f"`{text}`")), ngram)).alias("f"))
    return feats.groupBy(bucket_of(F.col("f"), buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", ngram: int = NGRAM,
          buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket as an array of ``buckets`` longs; only bucket sums reach the driver."""
    s = np.zeros(buckets, np.int64)
    t = np.zeros(buckets, np.int64)
    for counts, into in ((bucket_counts(docs, text, ngram, buckets), s), (bucket_counts(target, text, ngram, buckets), t)):
        for r in counts.collect():  # at most ``buckets`` rows
            into[r.bucket] = r.n
    big_s, big_t = float(s.sum()), float(t.sum())
    ratio = ((t + 1.0) * (big_s + buckets)) / ((s + 1.0) * (big_t + buckets))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10)
    u = (h.cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(u)))


def scored(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
           ngram: int = NGRAM, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, row`` for each row of ``docs``."""
    table = gains(docs, target, text, ngram, buckets)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), words(F.col(f"`{text}`")).alias("w"))
    rows = rows.select("doc_id", F.size("w").alias("n_words"),
                       F.transform(features(F.col("w"), ngram), lambda f: bucket_of(f, buckets)).alias("b"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            lengths = np.diff(offsets)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            each = table[flat] if len(flat) else np.zeros(0, np.int64)
            sums = np.zeros(len(lengths), np.int64)
            full = lengths > 0
            if full.any():
                sums[full] = np.add.reduceat(each, offsets[:-1][full])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(sums, pa.int64())], names=schema.names)

    weighed = rows.mapInArrow(weigh, schema)
    score = F.when(F.col("doc_id").isNotNull(), F.col("weight") + gumbel(F.col("doc_id"), seed))
    return weighed.select("doc_id", "n_words", "n_features", "weight", score.alias("score"),
                          F.monotonically_increasing_id().alias("row"))


def _ahead(key: tuple) -> Column:
    """Rows that come before ``key`` = (score, doc_id, row) in the drawing order."""
    score, doc_id, row = key
    s, d, r = F.col("score"), F.col("doc_id"), F.col("row")
    return (s > score) | ((s == score) & ((d < doc_id) | ((d == doc_id) & (r < row))))


def _medians(left: DataFrame) -> list[tuple[int, tuple]]:
    """Size and median key of what is left in each partition: one row per partition."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        n = sum(b.num_rows for b in parts)
        if not n:
            return
        cols = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in parts]) for i in range(3)]
        score, doc_id, row = cols
        order = np.lexsort((row, doc_id, -score))
        m = order[(n - 1) // 2]
        yield pa.RecordBatch.from_pylist(
            [{"n": n, "score": float(score[m]), "doc_id": int(doc_id[m]), "row": int(row[m])}], schema=pa.schema(
                [("n", pa.int64()), ("score", pa.float64()), ("doc_id", pa.int64()), ("row", pa.int64())]))

    got = left.select("score", "doc_id", "row").mapInArrow(each, _KEY).collect()
    return [(r.n, (r.score, r.doc_id, r.row)) for r in got]


def cutoff(candidates: DataFrame, k: int) -> tuple | None:
    """Key of the ``k``-th row of ``candidates`` (``score, doc_id, row``, all distinct) in drawing order."""
    if k <= 0:
        return None
    left, need = candidates, k
    while True:
        medians = sorted(_medians(left), key=lambda m: (-m[1][0], m[1][1], m[1][2]))
        if not medians:
            return None
        half, seen = sum(n for n, _ in medians) / 2, 0
        for n, key in medians:
            seen += n
            if seen >= half:
                pivot = key
                break
        ahead = left.where(_ahead(pivot)).count()
        if need <= ahead:
            left = left.where(_ahead(pivot))
        elif need == ahead + 1:
            return pivot
        else:
            need -= ahead + 1
            left = left.where(~_ahead(pivot) & ~((F.col("score") == pivot[0]) & (F.col("doc_id") == pivot[1])
                                                 & (F.col("row") == pivot[2])))


def numbered(winners: DataFrame, spark: SparkSession) -> DataFrame:
    """``row, rank`` in drawing order: sorted by range, counted per partition, offsets summed."""
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("row").asc()]
    placed = stored(winners.repartitionByRange(*order).sortWithinPartitions(*order)
                    .select("row", F.monotonically_increasing_id().alias("place")), spark, "drawn")
    part = F.shiftright("place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return placed.withColumn("part", part).join(before, "part").select(
        "row", (F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
             ngram: int = NGRAM, buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS,
             percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row; ``rank`` null if not drawn."""
    spark = docs.sparkSession
    all_rows = stored(scored(docs, target, doc_id, text, ngram, buckets, seed), spark, "scores")
    candidates = all_rows.where((F.col("n_words") >= min_words) & F.col("score").isNotNull())
    k = candidates.count() * percent // 100
    key = cutoff(candidates.select("score", "doc_id", "row"), k)
    if key is None:
        ranks = all_rows.where(F.lit(False)).select("row", F.lit(None).cast("long").alias("rank"))
    else:
        drawn = candidates.where(_ahead(key) | ((F.col("score") == key[0]) & (F.col("doc_id") == key[1])
                                                & (F.col("row") == key[2])))
        ranks = numbered(drawn.select("score", "doc_id", "row"), spark)
    return all_rows.join(ranks, "row", "left").select(
        "doc_id", "n_words", "n_features", "weight", F.col("score").cast("long").alias("score"), "rank")
