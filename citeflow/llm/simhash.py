"""SimHash near-duplicates, found by multi-index hashing.

A fingerprint is the majority vote of the 64 bits of all shingle hashes. Two fingerprints link if
at most three bits differ. One of their two halves then differs in at most one bit, so each half
is indexed and asked for its Hamming ball of radius 1; what the index returns is verified over
all 64 bits. Only distinct fingerprints are compared, so copies cost one row however many there
are. Of a pair whose halves differ in one bit, the side that has 0 there asks for the other:
balls hold only the bits that can still be set, 17 keys to a half on average.

Components of linked fingerprints come from :mod:`citeflow.llm.graph`.

Defined results: a null, empty or blank text has fingerprint zero and links like any other; a
null id counts for no component (its row gets the smallest id of the others, or null); repeated
rows are copies; an empty table gives an empty table.
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
from citeflow.llm.words import spaced_words

SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
# Hashes whose bits are unpacked at a time: 64 bytes each.
_BLOCK = 1 << 16


def shingle_hashes(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of the lower-cased (A-Z) text; the UTF-8 bytes split at ASCII blanks."""
    words = spaced_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = [b" ".join(p) for p in zip(*(words[k:] for k in range(shingle)))]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(p, SEED) for p in parts), np.uint64, len(parts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is 1 if it is set in over half the hashes."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = hashes[at:at + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 shingle: int = SHINGLE) -> DataFrame:
    """``keep`` and ``fp``, the fingerprint as a signed long, for each row."""
    rows = docs.select(*(f"`{c}`" for c in keep), F.col(f"`{text}`").cast("binary").alias("_text"))
    schema = T.StructType([f for f in rows.schema if f.name != "_text"] + [T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = [fingerprint(shingle_hashes(t, shingle)) for t in texts]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fp], names=schema.names)

    return rows.mapInArrow(run, schema)


def links(distinct: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints (column ``fp``) with 1 to ``max_distance`` differing bits.

    ``max_distance`` is 3 at most: halves and balls of radius 1 find no more.
    """
    if not 1 <= max_distance <= 3:
        raise ValueError("max_distance must be 1, 2 or 3")
    low, high = "fp & 4294967295L", "shiftrightunsigned(fp, 32)"
    side = "4294967296L"  # marks keys of the upper half
    halves = distinct.selectExpr("fp", f"explode(array({low}, ({high}) | {side})) AS half")
    index = halves.select(F.col("half").alias("key"), F.col("fp").alias("b"))
    ball = (
        "concat(array(half), transform(filter(sequence(0, 31), i -> (half & shiftleft(1L, i)) = 0), "
        "i -> half | shiftleft(1L, i)))"
    )
    asked = halves.selectExpr("fp AS a", "half", f"explode({ball}) AS key")
    # Equal halves are found from both sides, and pairs that agree in one half and nearly in the
    # other more than once.
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance) & (
        (F.col("half") != index["key"]) | (F.col("a") < F.col("b"))
    )
    found = asked.join(index, (asked["key"] == index["key"]) & near & (F.col("a") != F.col("b")))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def groups(marked: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``fp, root, component_id`` of each distinct fingerprint of stored rows with ``fp``."""
    spark = marked.sparkSession
    first = stored(marked.groupBy("fp").agg(F.min(f"`{doc_id}`").alias("first_id")), spark, "fps")
    roots = components(links(first.select("fp")))
    rooted = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    linked = rooted.where("root <> fp").select("root", "first_id").union(
        roots.where("node = root").join(first, roots["node"] == first["fp"]).select("root", "first_id")
    )
    best = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
    return rooted.join(best, "root", "left").select(
        "fp", "root", F.coalesce("least_id", "first_id").alias("component_id")
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row."""
    spark = docs.sparkSession
    marked = stored(fingerprints(docs, text, (doc_id,), shingle), spark, "fingerprints")
    found = stored(groups(marked, doc_id), spark, "groups")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(found, "fp").select(doc_id, hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             shingle: int = SHINGLE) -> DataFrame:
    """One row of each group, that with the smallest id; the columns are those of ``docs``.

    Rows of the same id and different texts are told apart by a hash of the whole row; of rows
    that agree in every column one stays.
    """
    spark = docs.sparkSession
    whole = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    tagged = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                         F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"),
                         whole.alias("_hash"))
    marked = stored(fingerprints(tagged, "_text", ("_id", "_hash"), shingle), spark, "fingerprints")
    found = groups(marked, "_id").select("fp", "root")
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_hash").alias("hash"))
    # Copies are reduced to one row before the join, so no task gets a large group of them.
    firsts = marked.groupBy("fp").agg(F.min(order).alias("best"))
    best = firsts.join(found, "fp").groupBy("root").agg(F.min("best").alias("best")).select(
        F.col("best.id").alias("best_id"), F.col("best.hash").alias("best_hash")
    )
    rows = tagged.select("row", "_id", "_hash")
    same = rows["_id"].eqNullSafe(best["best_id"]) & (rows["_hash"] == best["best_hash"])
    return rows.join(best, same, "left_semi").dropDuplicates(["_id", "_hash"]).select("row.*")
