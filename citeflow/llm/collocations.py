"""Collocations mined from counts read off depth-truncated suffix subtrees, partitioned vertically.

Every word occurrence starts a suffix of its piece; cut at ``depth`` words it is a leaf of the
piece's suffix tree, and the leaf's total is how often that truncated suffix occurs. A phrase's
count is the sum of the totals of the leaves below its node.

0. Pruning: every phrase of up to ``depth`` words counts in one of many hashed buckets. No phrase of
   a bucket that holds fewer than ``min_count`` occurrences is frequent, so a leaf ends before the
   first phrase of such a bucket. A frequent phrase keeps all its occurrences, whatever shares its
   bucket; a full bucket prunes less and changes no result. Buckets follow the input's bytes up to
   2^31, are summed shard by shard, and their bits are files that tasks read.
1. Leaf totals per language: summed over the words of a group of texts first, then one aggregate,
   combined before the shuffle, so a frequent phrase costs one row per task.
2. Vertical partitioning: leaves are filed under their first word. A first word whose subtree
   holds more than ``budget`` leaves is split by its first two words, and those by all three,
   so no unit is larger than the budget unless it is a single leaf. Units, sorted, are packed
   into groups of at most ``budget`` leaves within each range partition.
3. Each group builds its subtrees on its own: its leaves sorted, node counts summed over the runs
   of leaves that share a prefix. A node that a split cut into several units is summed again
   across them; no other count is shuffled a second time.
4. Candidates, cuts and scores: a phrase of 2 to ``depth`` words occurring ``min_count`` times or
   more; each cut after the first k words scores ``floor(10^6 a^2 / (l r))`` in exact decimals,
   the lowest cut counts (ties to the smallest k). A candidate inside a longer candidate that
   holds at least ``share`` percent of its occurrences goes. The first ``top`` of each language
   are taken per hash slice first and then among those, so no task sorts a whole language.

Texts are lower-cased in A-Z, cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words
``[^\\x20\\x09]+``; phrases never cross pieces.

Defined results: a null text is empty; a null language is ``und``; repeated rows count each time;
an empty table, or one without a phrase often enough, gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeflow.llm.files import attempt_name, make_dir, open_read, open_write
from citeflow.llm.graph import stored
from citeflow.plans.workspace import new_dir

# Fixed values of the operator's contract.
PIECE = b".,;:!?\n\x0b\x0c\r"
BLANK = b" \t"
DEPTH = 3
MIN_COUNT = 10
SHARE = 50
TOP = 2000
UNKNOWN = "und"

# Leaves of a group: a task holds them as Python strings, about half a kilobyte for each leaf.
BUDGET = 1 << 17
SLICES = 64

# Text taken at a time.
GROUP_BYTES = 1 << 22
# Bytes of text for each bucket, the most buckets there are, and those of a shard.
BUCKET_BYTES, MOST_BITS, SHARD_BITS = 12, 31, 20

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_KIND = np.array([2 if b in PIECE else 1 if b in BLANK else 0 for b in range(256)], np.uint8)


class _Words:
    """The words of a group of texts: ``codes`` into the distinct ones, language codes, piece numbers."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        lines = pc.binary_join_element_wise(texts.fill_null("").cast(pa.string()), "", "\n")  # ends the last piece
        offsets = np.frombuffer(lines.buffers()[1], np.int32)[:len(lines) + 1]
        data = np.frombuffer(lines.buffers()[2], np.uint8)[:offsets[-1]]
        kind = _KIND[data]
        word = kind == 0
        edge = np.flatnonzero(np.diff(word, prepend=False))
        starts, sizes = edge[::2], edge[1::2] - edge[::2]
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(_LOWER[data[word]]))
        coded, named = words.dictionary_encode(), langs.fill_null(UNKNOWN).cast(pa.string()).dictionary_encode()
        self.distinct, self.codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.named = named.dictionary
        self.langs = named.indices.to_numpy()[np.searchsorted(offsets, starts, "right") - 1].astype(np.int64)
        self.pieces = np.cumsum(kind == 2)[starts]

    def longer(self, at: np.ndarray, d: int) -> np.ndarray:
        """Those of the places from which the piece holds ``d`` words."""
        at = at[at < len(self.codes) - d + 1]
        return at[self.pieces[at + d - 1] == self.pieces[at]]

    def buckets(self, bits: int):
        """For a place and a number of words, one more at each call, the phrase's bucket."""
        hashed = lambda names: np.fromiter(
            map(xxhash.xxh64_intdigest, names.to_numpy(zero_copy_only=False)), np.uint64, len(names))
        words, state = hashed(self.distinct), hashed(self.named)[self.langs]

        def step(at: np.ndarray, d: int) -> np.ndarray:
            h = state[at] * np.uint64(0x9E3779B97F4A7C15) + words[self.codes[at + d - 1]]
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            state[at] = h ^ (h >> np.uint64(29))
            return (state[at] >> np.uint64(64 - bits)).astype(np.uint32)

        return step


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[_Words]:
    for batch in batches:
        step = max(1, batch.num_rows * GROUP_BYTES // max(1, batch.nbytes))
        for first in range(0, batch.num_rows, step):
            words = _Words(batch.column(0).slice(first, step), batch.column(1).slice(first, step))
            if len(words.codes):
                yield words


def _packed_counts(buckets: np.ndarray, most: int) -> Iterator[tuple[int, bytes]]:
    """Shard and counts, at most ``most`` each: the buckets' distances in planes of bytes, then the counts."""
    found, counts = np.unique(buckets, return_counts=True)
    shards = found >> np.uint32(SHARD_BITS)
    edges = np.flatnonzero(np.diff(shards, prepend=shards[0] + 1, append=shards[-1] + 1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        gaps = np.diff(found[a:b] & np.uint32((1 << SHARD_BITS) - 1), prepend=np.uint32(0)).astype("<u4")
        body = gaps.view(np.uint8).reshape(-1, 4).T.tobytes() + np.minimum(counts[a:b], most).astype(np.uint8).tobytes()
        yield int(shards[a]), zlib.compress(body, 1)


def _unpacked_counts(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zlib.decompress(body), np.uint8).reshape(5, -1)
    return np.cumsum(np.ascontiguousarray(data[:4].T).view("<u4").ravel()), data[4]


def _frequent_buckets(rows: DataFrame, depth: int, min_count: int) -> tuple[int, list[tuple[int, str]]]:
    """How many bits number a bucket, and each shard's file of bits: is the bucket's count ``min_count``?"""
    spark, most = rows.sparkSession, min(min_count, 127)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(8, (size // BUCKET_BYTES).bit_length()))
    folder = new_dir(spark, "buckets")
    make_dir(f"{folder}/files")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _groups(batches):
            at, step, found = np.arange(len(words.codes)), words.buckets(bits), []
            for d in range(1, depth + 1):
                at = words.longer(at, d)
                found.append(step(at, d))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*_packed_counts(np.concatenate(found), most)), (pa.int32(), pa.binary()))],
                names=["shard", "body"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, total = None, None

        def done() -> pa.RecordBatch:
            path = f"{folder}/files/{attempt_name(f'bits-{shard}')}"
            with open_write(path) as file:
                file.write(np.packbits(total >= most, bitorder="little").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([path])], names=["shard", "path"])

        for batch in batches:
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                if k != shard:
                    if shard is not None:
                        yield done()
                    shard, total = k, np.zeros(1 << SHARD_BITS, np.uint8)
                places, counts = _unpacked_counts(body.as_py())
                total[places] = np.minimum(total[places] + counts, most)
        if shard is not None:
            yield done()

    counted = rows.mapInArrow(count, "shard INT, body BINARY").repartition("shard").sortWithinPartitions("shard")
    counted.mapInArrow(add, "shard INT, path STRING").write.parquet(f"{folder}/manifest")
    return bits, [tuple(r) for r in spark.read.parquet(f"{folder}/manifest").collect()]


_bits: dict[str, np.ndarray] = {}


def _read_bits(bits: int, files: list[tuple[int, str]]) -> np.ndarray:
    """All shards' bits; those last read by a Python worker are kept."""
    key = files[0][1]
    if key not in _bits:
        _bits.clear()
        size = 1 << (SHARD_BITS - 3)
        whole = np.zeros(max(1 << bits >> 3, size), np.uint8)
        for shard, path in files:
            with open_read(path) as file:
                whole[shard * size:(shard + 1) * size] = np.frombuffer(file.read(), np.uint8)
        _bits[key] = whole
    return _bits[key]


def _leaf_totals(words: _Words, depth: int, bits: int, frequent: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """``lang, leaf, c``: each place's leaf, as long as its phrases' buckets are frequent."""
    step, base = words.buckets(bits) if frequent is not None else None, len(words.distinct) + 1
    at = np.arange(len(words.codes))
    keys, sizes = words.langs.copy(), np.zeros(len(at), np.int64)
    room = len(words.named)
    for d in range(1, depth + 1):
        at = words.longer(at, d)
        if frequent is not None:
            b = step(at, d)
            at = at[(frequent[b >> np.uint32(3)] >> (b & np.uint32(7)).astype(np.uint8)) & 1 == 1]
        if room * base >= 1 << 62:  # the leaves so far, by number
            keys = np.unique(keys, return_inverse=True)[1]
            room = len(keys)
        room *= base
        keys *= base
        keys[at] += words.codes[at + d - 1] + 1
        sizes[at] = d
    _, firsts, counts = np.unique(keys, return_index=True, return_counts=True)
    for d in range(depth + 1):
        of = firsts[sizes[firsts] == d]
        if len(of):
            parts = [words.distinct.take(pa.array(words.codes[of + i])) for i in range(d)]
            leaf = pc.binary_join_element_wise(*parts, " ") if d else pa.array([""] * len(of))
            yield pa.RecordBatch.from_arrays(
                [words.named.take(pa.array(words.langs[of])), leaf, pa.array(counts[sizes[firsts] == d], pa.int64())],
                names=["lang", "leaf", "c"])


def leaves(docs: DataFrame, text: str = "text", lang: str = "lang", depth: int = DEPTH,
           min_count: int = 1) -> DataFrame:
    """``lang, leaf, c``: each suffix of each piece cut at ``depth`` words, and its total.

    A leaf is its words joined by one blank (words hold none), the smallest row to shuffle. Leaves
    end before a phrase that occurs fewer than ``min_count`` times; the leaf of no word counts
    the places where the first word does.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    bits, files = _frequent_buckets(rows, depth, min_count) if min_count > 1 else (0, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = _read_bits(bits, files) if files else None
        for words in _groups(batches):
            yield from _leaf_totals(words, depth, bits, frequent)

    found = rows.mapInArrow(run, "lang STRING, leaf STRING, c BIGINT")
    return found.groupBy("lang", "leaf").agg(F.sum("c").alias("c"))


def _prefix(leaf: Column, d: int) -> Column:
    return F.substring_index(leaf, " ", d)


def _units(tips: DataFrame, budget: int, depth: int) -> DataFrame:
    """``lang, leaf, c, unit, level``: the shortest prefix of the leaf whose subtree fits the budget.

    ``level`` is the number of words by which the leaf's first word was filed; a leaf shorter than
    that is a unit of its own.
    """
    unit = _prefix(F.col("leaf"), 1)
    for d in range(1, depth):
        sizes = tips.groupBy("lang", _prefix(F.col("leaf"), d).alias("p")).agg(F.count(F.lit(1)).alias("size"))
        large = sizes.where(F.col("size") > budget).select("lang", "p", F.lit(True).alias(f"large{d}"))
        tips = tips.join(large, (tips["lang"] == large["lang"]) & (_prefix(tips["leaf"], d) == large["p"]),
                         "left").select(tips["*"], f"large{d}")
    level = F.lit(1)
    for d in range(depth - 1, 0, -1):
        unit = F.when(F.col(f"large{d}").isNotNull(), _prefix(F.col("leaf"), d + 1)).otherwise(unit)
        level = level + F.col(f"large{d}").isNotNull().cast("int")
    return tips.select("lang", "leaf", "c", unit.alias("unit"), level.alias("level"))


def _packed(units: DataFrame, budget: int, spark: SparkSession) -> DataFrame:
    """``lang, unit, grp``: units in order, packed greedily within each range partition."""
    sizes = units.groupBy("lang", "unit").agg(F.count(F.lit(1)).alias("size"))
    ordered = sizes.repartitionByRange("lang", "unit").sortWithinPartitions("lang", "unit")
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("unit", T.StringType()),
                           T.StructField("grp", T.LongType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, local, filled, lang = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            grp = np.empty(batch.num_rows, np.int64)
            for i, (la, size) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                if filled and (filled + size > budget or la != lang):
                    local, filled = local + 1, 0
                filled, lang = filled + size, la
                grp[i] = (part << 32) | local
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(grp)], names=schema.names)

    return stored(ordered.mapInArrow(pack, schema), spark, "units")


def _node_counts(group: pd.DataFrame) -> pd.DataFrame:
    """Counts of every node of the group's subtrees, summed over runs of its sorted leaves.

    ``p1 .. pD`` are the leaf's first 1 .. D words (Spark cuts them); sorted by them, the leaves
    below one node stand together.
    """
    depth = int(group["size"].max())
    names = [f"p{d}" for d in range(1, depth + 1)]
    frame = group.sort_values(names, kind="stable")
    out = []
    for d in range(1, depth + 1):
        deep = frame[frame["size"].to_numpy() >= d]
        keys = deep[f"p{d}"].to_numpy()
        if not len(keys):
            continue
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sums = np.add.reduceat(deep["c"].to_numpy(), starts)
        split = np.maximum.reduceat(deep["level"].to_numpy(), starts) > d  # leaves in several units
        out.append(pd.DataFrame({"phrase": keys[starts], "n_words": d, "f": sums, "split": split}))
    rows = pd.concat(out, ignore_index=True)
    rows.insert(0, "lang", group["lang"].iloc[0])
    return rows


def counts(docs: DataFrame, text: str = "text", lang: str = "lang", depth: int = DEPTH,
           budget: int = BUDGET, min_count: int = 1) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, n_words, f`` of phrases of 1 to ``depth`` words, and ``lang, n``.

    Phrases that occur ``min_count`` times or more are all there; rarer ones may be.
    """
    spark = docs.sparkSession
    every = stored(leaves(docs, text, lang, depth, min_count), spark, "leaves")
    tips = every.where(F.col("leaf") != "")
    units = _units(tips, budget, depth)
    groups = _packed(units, budget, spark)
    filed = units.join(groups, ["lang", "unit"]).select(
        "lang", "grp", "c", "level", F.size(F.split("leaf", " ")).alias("size"),
        *(_prefix(F.col("leaf"), d).alias(f"p{d}") for d in range(1, depth + 1)))
    schema = "lang string, phrase string, n_words int, f long, split boolean"
    nodes = stored(filed.groupBy("lang", "grp").applyInPandas(_node_counts, schema), spark, "nodes")
    whole = nodes.where(~F.col("split")).drop("split")
    joined = nodes.where("split").groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f"))
    totals = every.groupBy("lang").agg(F.sum("c").alias("n"))
    return whole.unionByName(joined), totals


def _exact_score(a: str, l: str, r: str) -> Column:
    """``floor(10^6 a^2 / (l r))`` in 38-digit decimals: no product is rounded or wraps."""
    big = "decimal(38,0)"
    return F.expr(f"(cast({a} as {big}) * cast({a} as {big}) * 1000000) div (cast({l} as {big}) * cast({r} as {big}))")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", depth: int = DEPTH,
         min_count: int = MIN_COUNT, share: int = SHARE, top: int = TOP, budget: int = BUDGET,
         slices: int = SLICES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, k`` of the first ``top`` collocations of each language."""
    spark = docs.sparkSession
    phrases, totals = counts(docs, text, lang, depth, budget, min_count)
    # A part of a phrase occurs at least as often as the phrase: parts of candidates are frequent.
    frequent = stored(phrases.where(F.col("f") >= min_count), spark, "frequent")
    cands = frequent.where(F.col("n_words") >= 2).select(
        "lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = cands.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("right"))
    lhs = frequent.select(F.col("lang").alias("l_lang"), F.col("phrase").alias("left"), F.col("f").alias("l"))
    rhs = frequent.select(F.col("lang").alias("r_lang"), F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(lhs, (cuts["lang"] == lhs["l_lang"]) & (cuts["left"] == lhs["left"])).join(
        rhs, (cuts["lang"] == rhs["r_lang"]) & (cuts["right"] == rhs["right"]))
    cuts = cuts.select("lang", "phrase", "a", "k", "l", "r", _exact_score("a", "l", "r").alias("score"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")).select(
        "lang", "phrase", "b.*")
    # Strictly shorter parts (two words or more) of each candidate, with the candidate's count.
    parts = cands.select("lang", "a", "w", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(1), F.size("w")),
        lambda i: F.transform(F.sequence(i + 1, F.size("w")), lambda j: F.struct(i.alias("i"), j.alias("j"))),
    ))).alias("ij")).where("ij.j - ij.i + 1 < size(w)").select(
        "lang", "a", F.array_join(F.slice("w", F.col("ij.i"), F.col("ij.j") - F.col("ij.i") + 1), " ").alias("part"))
    held = parts.groupBy("lang", "part").agg(F.max("a").alias("held"))
    inside = best.join(held, (best["lang"] == held["lang"]) & (best["phrase"] == held["part"]), "left")
    kept = inside.where(held["held"].isNull() | (100 * held["held"] < share * best["a"])).select(best["*"])
    return _first(kept.join(totals, "lang"), top, slices)


def _first(rows: DataFrame, top: int, slices: int) -> DataFrame:
    """The first ``top`` of each language: within hash slices first, then among those."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    near = sliced.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order)))
    near = near.where(F.col("_r") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long"), "phrase", F.col("a").cast("long"), F.col("l").cast("long"),
        F.col("r").cast("long"), F.col("n").cast("long"), F.col("score").cast("long"), F.col("k").cast("long"))
