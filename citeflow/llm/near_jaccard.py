"""Near-duplicates by the Jaccard similarity of five-word shingles: 0.8 or more links two texts.

A 64-bit SimHash is of no help here: texts of similarity 0.8 differ in about 10 of its bits, and
an index for so many bits returns a good part of all pairs. Candidates come from MinHash bands
instead: ``BANDS`` keys of ``ROWS`` minima each. Two texts of similarity 0.8 share no key once in
6,600 pairs, at 0.85 once in 2 million. Every candidate is verified on the whole shingle sets.

Only distinct sets are compared. Within a bucket (the sets with one key) all are first compared
with the smallest, and then, across the components this gave, all with all: no pair of a bucket is
left out except those that are linked already, so a large group of near copies costs one
comparison a member.

Defined results: a null, empty or blank text has the empty set and is a copy of the others like
it; a text of fewer than five words is one shingle; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeflow.llm.graph import components, stored
from citeflow.llm.simhash import shingle_hashes

SHINGLE = 5
# Similarity as a fraction: exact in whole numbers.
SIMILAR = (4, 5)
BANDS, ROWS = 48, 8
# Shingles that are permuted at a time: 1.5 kB each.
_BLOCK = 1 << 12
_DRAWN = np.random.default_rng(42).integers(0, 1 << 31, (2, BANDS * ROWS, 1), np.uint32) * np.uint32(2) + np.uint32(1)


def bands(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of minima of distinct hashes, with the band's number in it."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), _BLOCK):
        mixed = low[at:at + _BLOCK] * _DRAWN[0]
        mixed ^= high[at:at + _BLOCK]
        mixed *= _DRAWN[1]
        np.minimum(least, mixed.min(axis=1), out=least)
    keys = (xxhash.xxh64_intdigest(part.tobytes(), k) for k, part in enumerate(least.reshape(BANDS, ROWS)))
    return np.fromiter(keys, np.uint64, BANDS).view(np.int64)


def _sets(rows: DataFrame, made: str, visit) -> DataFrame:
    """The rows with the columns ``made`` in place of the last one, a binary text."""
    fields = rows.schema.fields[:-1] + T.StructType.fromDDL(made).fields
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            new = visit([np.unique(shingle_hashes(t.as_py(), SHINGLE)) for t in texts])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=schema.names)

    return rows.mapInArrow(run, schema)


def _keyed(sets: list[np.ndarray]) -> list[pa.Array]:
    coded = [xxhash.xxh64_intdigest(s.tobytes()) for s in sets]
    return [
        pa.array(np.array(coded, np.uint64).view(np.int64)), pa.array([len(s) for s in sets], pa.int64()),
        pa.array([bands(s) for s in sets], pa.list_(pa.int64())),
    ]


def _whole(sets: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs ``a, b`` whose sets are similar."""
    part, whole = SIMILAR
    one = sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("x"))
    two = sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("y"))
    sizes = whole * F.least("n_a", "n_b") >= part * F.greatest("n_a", "n_b")
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(one, "a").join(two, "b").where(sizes).where(
        whole * both >= part * (F.col("n_a") + F.col("n_b") - both)
    ).select("a", "b")


def links(distinct: DataFrame, tagged: DataFrame) -> DataFrame:
    """Edges ``a, b`` between similar sets, whose components are those of all similar candidates.

    ``distinct`` holds ``key, n, bands, best`` of each set, ``tagged`` the rows that ``best`` names.
    """
    spark = distinct.sparkSession
    filed = distinct.select("key", F.explode("bands").alias("bucket"))
    least = filed.groupBy("bucket").agg(F.min("key").alias("leader"), F.count("key").alias("size"))
    met = stored(filed.join(least.where("size > 1").drop("size"), "bucket"), spark, "buckets")

    named = met.select("key").distinct().join(distinct.select("key", "n", "best.*"), "key")
    texts = tagged.select("_id", "_hash", F.col("_text").cast("binary").alias("_text"))
    same = texts["_id"].eqNullSafe(named["id"]) & (texts["_hash"] == named["hash"])
    chosen = texts.join(named, same).select("key", "n", "_text")
    sets = _sets(chosen, "hashes ARRAY<BIGINT>", _whole)
    sets = stored(sets.groupBy("key").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes")), spark, "sets")

    led = met.where("key <> leader").select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct()
    edges = stored(_verified(led, sets), spark, "similar")
    roots = components(edges)

    def rooted(rows: DataFrame, node: str, root: str) -> DataFrame:
        named = roots.select(F.col("node").alias(node), F.col("root").alias("_root"))
        return rows.join(named, node, "left").withColumn(root, F.coalesce("_root", node)).drop("_root")

    labelled = stored(rooted(rooted(met, "key", "root"), "leader", "led_by"), spark, "buckets")
    # One side of a pair that is not linked yet is outside the leader's component.
    apart = labelled.where("root <> led_by").select("bucket", F.col("key").alias("a"), F.col("root").alias("root_a"))
    others = labelled.where("key <> leader").select(
        "bucket", F.col("key").alias("b"), F.col("root").alias("root_b"), "led_by")
    once = (F.col("root_b") == F.col("led_by")) | (F.col("a") < F.col("b"))
    cross = apart.join(others, (apart["bucket"] == others["bucket"]) & (F.col("root_a") != F.col("root_b")) & once)
    cross = cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return edges.union(_verified(cross, sets))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of linked texts, that with the smallest id; the columns are those of ``docs``.

    Rows of the same id and different texts are told apart by a hash of the whole row; of rows
    that agree in every column one stays.
    """
    spark = docs.sparkSession
    whole = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    tagged = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                         F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"),
                         whole.alias("_hash"))
    rows = tagged.select("_id", "_hash", F.col("_text").cast("binary").alias("_text"))
    marked = _sets(rows, "key BIGINT, n BIGINT, bands ARRAY<BIGINT>", _keyed)
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_hash").alias("hash"))
    distinct = stored(marked.groupBy("key").agg(
        F.min(order).alias("best"), F.first("n").alias("n"), F.first("bands").alias("bands"),
    ), spark, "shingled")
    roots = components(links(distinct, tagged)).withColumnRenamed("node", "key")
    best = distinct.select("key", "best").join(roots, "key", "left").groupBy(
        F.coalesce("root", "key").alias("root")).agg(F.min("best").alias("best")).select(
        F.col("best.id").alias("best_id"), F.col("best.hash").alias("best_hash")
    )
    kept = tagged.select("row", "_id", "_hash")
    same = kept["_id"].eqNullSafe(best["best_id"]) & (kept["_hash"] == best["best_hash"])
    return kept.join(best, same, "left_semi").dropDuplicates(["_id", "_hash"]).select("row.*")
