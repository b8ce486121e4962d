"""An n-gram language model in an Elias-Fano trie, built and asked by Spark tasks.

Level 1 holds the words of the training texts, sorted by a 63-bit hash (distinct words never share
one: the build checks and takes another seed if they do). Level k + 1 holds the n-grams of k + 1
tokens that were seen at least ``min_count`` times, 1 for the whole counts: per entry of level k, its context, a range of
successors. Where a range begins is a monotone sequence of pointers; successors are made monotone
by adding the last value of the range before, and both are Elias-Fano coded. A look-up takes the
context's range and its base, and searches the successor of base plus word in that range.

Probabilities are smoothed by absolute discounting: an n-gram has ``(c - D) / c(context)`` and the
context's left-over weight times the probability after the shorter context. Both are stored as
multiples of 1/2000 of a negative decimal logarithm in 16 bits.

Texts are coded once, as numbers of their words, and stored; later passes read the numbers.
The n-grams of a level are cut into ranges of context and next word by the counts of the contexts, so
that a range holds a bounded number of occurrences; those of a hot context are spread over ranges
by their next word. A task counts its n-grams a chunk at a time and sends each range a packed block of
them; Spark brings a range's blocks together, and the range is summed and written as one shard. Then
each shard gets its left-over weights and probabilities; what a context has in several shards is
summed from a row per shard, which is all the driver sees. A level is never in one task.

Defined results: a null or empty text is the end token alone; a null id is held out; repeated rows
are learned from and scored each; an empty table gives an empty one; without any training text
every token has the base probability of an unknown one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeflow.llm.elias_fano import EliasFano, read_arrays, write_arrays
from citeflow.llm.files import attempt_name, make_dir
from citeflow.llm.graph import stored
from citeflow.llm.words import spaced_words
from citeflow.plans.workspace import new_dir

ORDER = 3
MIN_COUNT = 2
DISCOUNT = 0.75
STEPS = 2000
END = b""  # no word is empty
CHUNK_TOKENS = 1 << 18
CODED_CHUNK = 4  # times as many where tokens are numbers: each chunk looks into every shard
COUNTER_WORDS = 200_000
HASH_BITS = 63
WEIGHT_BITS = 20  # occurrences to a shard, at most
LEAST_SHARD = 1 << 14
SHARD = (
    "level INT, place INT, path STRING, n BIGINT, total BIGINT, first_parent BIGINT, first_word BIGINT, clashes BIGINT"
)


def quantised(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-30)) * STEPS), 0, 65535).astype(np.uint16)


def hashes(words: list[bytes], seed: int, bits: int = HASH_BITS) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    coded = np.fromiter(map(digest, words, repeat(seed)), np.uint64, len(words))
    return (coded >> np.uint64(64 - bits)).astype(np.int64)


class Shard(NamedTuple):
    path: str
    base: int
    n: int
    first_parent: int
    first_word: int
    values: str = ""  # the file of probabilities and of the contexts' left-over weights


class Trie:
    """Mapped levels: ``levels[k]`` lists the shards of level ``k + 1``."""

    def __init__(self, seed: int, levels: list[list[Shard]], tokens: int, hash_bits: int = HASH_BITS,
                 min_count: int = MIN_COUNT):
        self.seed, self.levels, self.tokens = seed, levels, tokens
        self.hash_bits, self.min_count = hash_bits, min_count
        self.words = sum(s.n for s in levels[0])
        self.unit = 1 / (tokens + self.words + 1)  # of a token never seen
        self._open: dict[str, object] = {}

    def __getstate__(self):
        return {**self.__dict__, "_open": {}}

    def _shard(self, shard: Shard) -> dict:
        found = self._open.get(shard.path)
        if found is None:
            arrays = read_arrays(shard.path) | (read_arrays(shard.values) if shard.values else {})
            found = self._open[shard.path] = dict(arrays)
            for name in ("ids", "pointers"):
                if f"{name}.size" in arrays:
                    found[name] = EliasFano.of(arrays, name)
        return found

    def word_ids(self, words: list[bytes]) -> np.ndarray:
        """Numbers at level 1, -1 for unknown words."""
        number = {w: k for k, w in enumerate(dict.fromkeys(words))}
        plain = hashes(list(number), self.seed, self.hash_bits)
        order = np.argsort(plain)
        coded = plain[order]
        ids = np.full(len(coded), -1, np.int64)
        cuts = np.searchsorted(coded, [s.first_word for s in self.levels[0]]).tolist() + [len(coded)]
        for shard, start, end in zip(self.levels[0], cuts, cuts[1:]):
            if start < end:
                ef, asked = self._shard(shard)["ids"], coded[start:end]
                at = ef.successor(asked)
                inside = at < ef.n
                same = np.zeros(len(at), bool)
                same[inside] = ef.access(at[inside]).astype(np.int64) == asked[inside]
                ids[start:end][same] = shard.base + at[same]
        unsorted = np.empty_like(ids)
        unsorted[order] = ids
        return unsorted[np.fromiter(map(number.__getitem__, words), np.int64, len(words))]

    def find(self, level: int, parents: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Numbers at ``level`` (2 or more) of the words after contexts, -1 where not stored."""
        if not self.levels[level - 1] or not len(parents):
            return np.full(len(parents), -1, np.int64)
        pairs, back = _unique_pairs(parents, words)
        parents, words = pairs
        found = np.full(len(parents), -1, np.int64)
        cuts = [_lower(parents, words, s.first_parent, s.first_word) for s in self.levels[level - 1]] + [len(parents)]
        for shard, start, end in zip(self.levels[level - 1], cuts, cuts[1:]):
            if start == end:
                continue
            data = self._shard(shard)
            context, times = np.unique(parents[start:end] - shard.first_parent, return_counts=True)
            inside = context < data["pointers"].n - 1  # contexts beyond have no successors here
            first, last, base = (np.zeros(len(context), np.int64) for _ in range(3))
            first[inside] = data["pointers"].access(context[inside]).astype(np.int64)
            last[inside] = data["pointers"].access(context[inside] + 1).astype(np.int64)
            later = (first > 0) & (first < last)
            base[later] = data["ids"].access(first[later] - 1).astype(np.int64)
            first, last, base = (np.repeat(v, times) for v in (first, last, base))
            known = np.flatnonzero(first < last)
            first, last = first[known], last[known]
            value = base[known] + words[start:end][known] + 1
            at = data["ids"].successor(value, first, last)
            same = at < last
            same[same] = data["ids"].access(at[same]).astype(np.int64) == value[same]
            found[start:end][known[same]] = shard.base + at[same]
        return found[back]

    def last_words(self, level: int, entries: np.ndarray) -> np.ndarray:
        """The last token of entries of ``level``."""
        words = np.empty(len(entries), np.int64)
        for data, at, rows in self._entries(level, entries):
            if level == 1:
                words[rows] = entries[rows]
                continue
            context = data["pointers"].successor(at + 1) - 1
            first = data["pointers"].access(context).astype(np.int64)
            base = np.zeros(len(at), np.int64)
            later = first > 0
            base[later] = data["ids"].access(first[later] - 1).astype(np.int64)
            words[rows] = data["ids"].access(at).astype(np.int64) - base - 1
        return words

    def _entries(self, level: int, entries: np.ndarray) -> Iterator[tuple]:
        shards = self.levels[level - 1]
        for k, rows in _by_shard(entries, [s.base for s in shards]):
            yield self._shard(shards[k]), entries[rows] - shards[k].base, rows

    def values(self, level: int, name: str, entries: np.ndarray) -> np.ndarray:
        """``count`` or ``prob`` of entries."""
        got = np.zeros(len(entries), np.int64)
        for data, at, rows in self._entries(level, entries):
            got[rows] = _full_counts(data, at) if name == "count" else data[name][at]
        return got

    def weight(self, level: int, entries: np.ndarray) -> np.ndarray:
        """Stored logarithms of left-over weights; 0 for contexts without successors."""
        got, shards = np.zeros(len(entries), np.int64), self.levels[level]
        for k, rows in _by_shard(entries, [s.first_parent for s in shards]):
            weight, at = self._shard(shards[k])["weight"], entries[rows] - shards[k].first_parent
            inside = at < len(weight)
            got[rows[inside]] = weight[at[inside]]
        return got


def _by_shard(entries: np.ndarray, firsts: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard's number, and the rows of its entries; entries before the first are left out."""
    order = np.argsort(entries)
    cuts = np.append(np.searchsorted(entries[order], firsts), len(entries))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        yield k, order[cuts[k]:cuts[k + 1]]


def _small_counts(c: np.ndarray) -> dict[str, np.ndarray]:
    """Counts in a byte each, and those of 255 or more by their places."""
    over = np.flatnonzero(c >= 255)
    return {"count": np.minimum(c, 255).astype(np.uint8), "over": over, "more": c[over].astype(np.int64)}


def _full_counts(data: dict, at: np.ndarray) -> np.ndarray:
    got = data["count"][at].astype(np.int64)
    if "over" in data:
        large = np.flatnonzero(got == 255)
        got[large] = data["more"][np.searchsorted(data["over"], at[large])]
    return got


def _unique_pairs(parents: np.ndarray, words: np.ndarray) -> tuple:
    width = int(words.max()) + 1
    if int(parents.max()) + 1 < (1 << 62) // width:
        keys, back = np.unique(parents * width + words, return_inverse=True)
        return (keys // width, keys % width), back
    pairs, back = np.unique(np.stack([parents, words], axis=1), axis=0, return_inverse=True)
    return (pairs[:, 0], pairs[:, 1]), back


def _lower(parents: np.ndarray, words: np.ndarray, parent: int, word: int) -> int:
    """First place of sorted pairs that is not before a pair."""
    start, end = np.searchsorted(parents, [parent, parent + 1])
    return int(start + np.searchsorted(words[start:end], word))


class Tokens(NamedTuple):
    """Texts one after another: numbers of tokens, and the text each belongs to."""

    ids: np.ndarray
    text: np.ndarray


def _chunks(texts: Iterator, tokens: int) -> Iterator[list]:
    """Texts in lists of about so many tokens."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= tokens:
            yield held
            held, size = [], 0
    if held:
        yield held


def _tokens(texts: list[np.ndarray]) -> Tokens:
    return Tokens(np.concatenate(texts).astype(np.int64), np.repeat(np.arange(len(texts)), [len(t) for t in texts]))


def _coded(column: pa.Array) -> Iterator[np.ndarray]:
    """Numbers of the tokens of each text, as :func:`_encode` stores them."""
    return (np.frombuffer(v.as_py(), "<i4") for v in column)


def _encode(rows: DataFrame, shared) -> DataFrame:
    """The rows with ``ids``, the numbers of their tokens (-1: unknown), in place of ``body``."""
    size = CHUNK_TOKENS
    schema = T.StructType([*(f for f in rows.schema if f.name != "body"), T.StructField("ids", T.BinaryType())])
    place = rows.columns.index("body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, others = 0, [c for k, c in enumerate(batch.columns) if k != place]
            for texts in _chunks(([*spaced_words(v.as_py()), END] for v in batch.column(place)), size):
                ids = shared.value.word_ids([w for t in texts for w in t]).astype("<i4")
                cuts = np.cumsum([len(t) for t in texts])[:-1]
                data = pa.array([part.tobytes() for part in np.split(ids, cuts)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, len(texts)) for c in others), data], names=schema.names
                )
                first += len(texts)

    return rows.mapInArrow(run, schema)


def _entries(trie: Trie, tokens: Tokens, levels: int) -> list[np.ndarray]:
    """For each level up to ``levels``, the number of the n-gram that ends at each token, or -1."""
    found = [tokens.ids]
    for level in range(2, levels + 1):
        at = _extensible(trie, tokens, found)
        here = np.full(len(tokens.ids), -1, np.int64)
        if len(at):
            here[at] = trie.find(level, found[-1][at - 1], tokens.ids[at])
        found.append(here)
    return found


def _extensible(trie: Trie, tokens: Tokens, found: list[np.ndarray]) -> np.ndarray:
    """Tokens after a stored context whose own shorter n-gram is stored: others were not seen often enough."""
    ok = (found[-1][1:] >= 0) & (found[-1][:-1] >= 0) & (tokens.text[1:] == tokens.text[:-1])
    at = np.flatnonzero(ok) + 1
    if len(found) == 1 and len(at) and trie.min_count > 1:
        often = _counts(trie, tokens.ids)
        at = at[(often[at] >= trie.min_count) & (often[at - 1] >= trie.min_count)]
    return at


def _counts(trie: Trie, ids: np.ndarray) -> np.ndarray:
    counts, known = np.zeros(len(ids), np.int64), ids >= 0
    if known.any():
        counts[known] = trie.values(1, "count", ids[known])
    return counts


def _batch(columns, kinds: str) -> pa.RecordBatch:
    fields = [f.split() for f in kinds.split(", ")]
    types = {"BIGINT": pa.int64(), "INT": pa.int32(), "STRING": pa.string(), "DOUBLE": pa.float64(), "BINARY": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _word_counts(texts: DataFrame, seed: int, hash_bits: int) -> DataFrame:
    """``h, c`` of each distinct token; words are told apart by themselves, not by their hash."""
    kinds, most = "h BIGINT, word BINARY, c BIGINT", COUNTER_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(spaced_words(text.as_py()))
                counts[END] += 1
                if len(counts) > most:
                    yield made(counts)
                    counts = Counter()
        if counts:
            yield made(counts)

    def made(counts: Counter) -> pa.RecordBatch:
        words = list(counts)
        return _batch((hashes(words, seed, hash_bits), words, list(counts.values())), kinds)

    return texts.mapInArrow(run, kinds).groupBy("word").agg(F.first("h").alias("h"), F.sum("c").alias("c")).select("h", "c")


def _gathered(batches: Iterator[pa.RecordBatch], columns: int) -> list[np.ndarray]:
    parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(columns)]


def _write_words(counted: DataFrame, folder: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, c = _gathered(batches, 2)
        if len(h):
            path = f"{folder}/{attempt_name('words')}"
            write_arrays(path, {**EliasFano.encode(h).arrays("ids"), "count": c.astype(np.uint64)})
            row = (1, int(path.rsplit("-", 2)[1]), path, len(h), int(c.sum()), 0, int(h[0]), int((h[1:] == h[:-1]).sum()))
            yield _batch([[v] for v in row], SHARD)

    return counted.repartitionByRange("h").sortWithinPartitions("h").mapInArrow(run, SHARD)


def _counted_pairs(parents: np.ndarray, words: np.ndarray, c: np.ndarray | None = None) -> tuple:
    """Distinct pairs in order, and how often each is there (or the sum of its ``c``)."""
    width = int(words.max()) + 1
    if int(parents.max()) + 1 < (1 << 62) // width:
        keys = parents * width + words
        if c is None:
            keys.sort()
        else:
            order = np.argsort(keys)
            keys, c = keys[order], c[order]
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        parents, words = np.divmod(keys[starts], width)
    else:
        order = np.lexsort((words, parents))
        parents, words, c = parents[order], words[order], None if c is None else c[order]
        starts = np.flatnonzero((np.diff(parents, prepend=-1) != 0) | (np.diff(words, prepend=-1) != 0))
        keys, parents, words = order, parents[starts], words[starts]
    return parents, words, np.diff(np.append(starts, len(keys))) if c is None else np.add.reduceat(c, starts)


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _packed(parents: np.ndarray, words: np.ndarray, c: np.ndarray, first: int) -> bytes:
    """A range's n-grams: distances of the contexts, next words and counts, in planes of bytes."""
    gaps = np.diff(parents, prepend=first)
    return zlib.compress(b"".join(map(_planes, (gaps, words, c))), 1)


def _unpacked(body: bytes, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(body), np.uint8).reshape(3, 4, -1)
    gaps, words, c = (np.ascontiguousarray(p.T).view("<u4").ravel().astype(np.int64) for p in planes)
    return first + np.cumsum(gaps), words, c


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _listed(spark: SparkSession, shards: list[Shard], more: list[tuple] = (), kinds: str = "") -> DataFrame:
    """A row for each shard, dealt over the tasks: its place in the list, and more of it."""
    rows = [(k, *(more[k] if more else ())) for k in range(len(shards))]
    # With a number, so that adaptive execution does not make one task of a few small rows.
    return spark.createDataFrame(rows, "place INT" + kinds).repartition(_tasks(spark), "place")


def _ranges(spark: SparkSession, shared, level: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and words with which ranges of n-grams of ``level`` begin.

    Contexts of ``size`` occurrences together make a range; one of more has several, by next word.
    """
    shards, width = shared.value.levels[level - 2], shared.value.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for place in (k for b in batches for k in b.column(0).to_pylist()):
            shard = trie.levels[level - 2][place]
            c = trie.values(level - 1, "count", shard.base + np.arange(shard.n))
            hot = c > size
            new = np.diff((np.cumsum(c) - c) // size, prepend=-1) != 0
            begin = np.flatnonzero(new | hot | np.append(False, hot[:-1]))
            pieces = np.where(hot[begin], -(-c[begin] // size), 1)
            number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            words = number * width // np.repeat(pieces, pieces)
            yield _batch((np.repeat(shard.base + begin, pieces), words), "parent BIGINT, word BIGINT")

    rows = _listed(spark, shards).mapInArrow(run, "parent BIGINT, word BIGINT").collect()
    found = np.array(sorted(set(map(tuple, rows))), np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def _places(parents: np.ndarray, words: np.ndarray, ranges: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Where each range begins among sorted pairs."""
    at = np.searchsorted(parents, ranges[0])
    for k in np.flatnonzero(ranges[1]):
        at[k] = _lower(parents, words, ranges[0][k], ranges[1][k])
    return at


COUNTED = "place INT, path STRING, n BIGINT, first_parent BIGINT, first_word BIGINT, last_parent BIGINT, first_mass DOUBLE, last_mass DOUBLE"


def _count_level(coded: DataFrame, shared, level: int, ranges, folder: str) -> DataFrame:
    """From one column of coded texts, a row and a file for each range of n-grams of ``level`` tokens.

    Kept are those seen at least ``min_count`` times.
    """
    size = CHUNK_TOKENS * CODED_CHUNK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, (firsts, _) = shared.value, ranges.value
        for chunk in _chunks((t for b in batches for t in _coded(b.column(0))), size):
            tokens = _tokens(chunk)
            found = _entries(trie, tokens, level - 1)
            at = _extensible(trie, tokens, found)
            if not len(at):
                continue
            grams = _counted_pairs(found[-1][at - 1], tokens.ids[at])
            cuts = np.append(_places(*grams[:2], ranges.value), len(grams[0]))
            own = np.flatnonzero(np.diff(cuts))
            bodies = [_packed(*(v[cuts[k]:cuts[k + 1]] for v in grams), firsts[k]) for k in own]
            yield _batch((own, bodies), "place INT, body BINARY")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, (firsts, _) = shared.value, ranges.value
        place, held = None, []
        for batch in batches:
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                if k != place and held:
                    yield from write(trie, place, held, firsts)
                    held = []
                place = k
                held.append(body.as_py())
        if held:
            yield from write(trie, place, held, firsts)

    def write(trie: Trie, place: int, bodies: list[bytes], firsts: np.ndarray) -> Iterator[pa.RecordBatch]:
        blocks = [_unpacked(b, firsts[place]) for b in bodies]
        parent, word, c = _counted_pairs(*(np.concatenate(v) for v in zip(*blocks)))
        often = c >= trie.min_count
        parent, word, c = parent[often], word[often], c[often]
        if not len(parent):
            return
        starts = np.searchsorted(parent, np.arange(parent[0], parent[-1] + 2))
        # Successors plus one, on top of the last value of the range before.
        begins = starts[:-1][np.diff(starts) > 0]
        top = np.cumsum(word[np.append(begins[1:], len(word)) - 1] + 1)
        ids = word + 1 + np.repeat(np.concatenate(([0], top[:-1])), np.diff(np.append(begins, len(word))))
        path = f"{folder}/{attempt_name(f'level{level}')}"
        write_arrays(path, {**EliasFano.encode(starts).arrays("pointers"), **EliasFano.encode(ids).arrays("ids"),
                            **_small_counts(c)})
        mass = np.add.reduceat(c - DISCOUNT, begins)
        row = (place, path, len(parent), int(parent[0]), int(word[0]), int(parent[-1]), float(mass[0]), float(mass[-1]))
        yield _batch([[v] for v in row], COUNTED)

    blocks = coded.mapInArrow(count, "place INT, body BINARY").repartition(_tasks(coded.sparkSession), "place").sortWithinPartitions("place")
    return blocks.mapInArrow(add, COUNTED)


def _edge_masses(rows: list) -> list[tuple[float, float]]:
    """For each shard, in order, the masses of its first and last context over all shards."""
    masses: Counter = Counter()
    for r in rows:
        masses[r.first_parent] += r.first_mass
        if r.last_parent != r.first_parent:
            masses[r.last_parent] += r.last_mass
    return [(masses[r.first_parent], masses[r.last_parent]) for r in rows]


def _write_values(spark: SparkSession, shared, level: int, masses: list[tuple[float, float]], folder: str) -> DataFrame:
    """For each shard of ``level``, a file of its contexts' left-over weights and its probabilities."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for place, first_mass, last_mass in (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))):
            shard = trie.levels[level - 1][place]
            data = trie._shard(shard)
            starts = data["pointers"].access(np.arange(data["pointers"].n)).astype(np.int64)
            sizes, c = np.diff(starts), _full_counts(data, np.arange(shard.n))
            contexts = np.flatnonzero(sizes)
            mass = np.add.reduceat(c - DISCOUNT, starts[contexts])
            mass[0], mass[-1] = first_mass, last_mass
            seen = trie.values(level - 1, "count", shard.first_parent + contexts)
            logs, weight = quantised(1 - mass / seen), np.zeros(len(sizes), np.uint16)
            weight[contexts] = logs
            left, seen = (np.repeat(v, sizes[contexts]) for v in (10 ** (-logs.astype(np.int64) / STEPS), seen))
            # Stored successors carry the last value of the range before, and one.
            ids = data["ids"].access(np.arange(shard.n)).astype(np.int64)
            before = np.concatenate(([0], ids[starts[contexts[1:]] - 1]))
            word = ids - 1 - np.repeat(before, sizes[contexts])
            parent = np.repeat(shard.first_parent + contexts, sizes[contexts])
            lower = 10 ** (-_lower_log(trie, level, parent, word) / STEPS)
            prob = (c - DISCOUNT) / seen + left * lower
            path = f"{folder}/{attempt_name(f'values{level}')}"
            write_arrays(path, {"prob": quantised(np.minimum(prob, 1.0)), "weight": weight})
            yield _batch(([place], [path]), "place INT, path STRING")

    listed = _listed(spark, shared.value.levels[level - 1], masses, ", first DOUBLE, last DOUBLE")
    return listed.mapInArrow(run, "place INT, path STRING")


def _first_log(trie: Trie, ids: np.ndarray) -> np.ndarray:
    """Quantised probabilities of single tokens."""
    return quantised((_counts(trie, ids) + 1) * trie.unit).astype(np.int64)


def _lower_log(trie: Trie, level: int, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Stored logarithm of the probability of words after contexts that are one token shorter."""
    if level == 2:
        return _first_log(trie, word)
    last = trie.last_words(level - 1, parent)
    return trie.values(2, "prob", trie.find(2, last, word))


def _shards(rows: list) -> list[Shard]:
    shards, base = [], 0
    for row in rows:
        shards.append(Shard(row.path, base, row.n, row.first_parent, row.first_word))
        base += row.n
    return shards


def build(rows: DataFrame, order: int = ORDER, hash_bits: int = HASH_BITS,
          weight_bits: int = WEIGHT_BITS, min_count: int = MIN_COUNT) -> tuple[Trie, DataFrame]:
    """The model of the rows that are ``learned``, from their binary ``body``, and all rows coded.

    The model's files and the coded rows (``ids`` in place of ``body``) are in the shared folder. A
    shard holds at most 2^weight_bits occurrences of n-grams, save of one n-gram.
    """
    if order not in (1, 2, 3):
        raise ValueError("order must be 1, 2 or 3")
    spark, texts = rows.sparkSession, rows.where("learned").select("body")
    folder = new_dir(spark, "lm")
    make_dir(folder)
    seed, clashes = 0, 1
    while clashes:
        seed += 1
        counted = stored(_word_counts(texts, seed, hash_bits), spark, "words")
        table = stored(_write_words(counted, folder), spark, "lmshards")
        tokens, clashes = table.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("clashes"), F.lit(0))).first()
    trie = Trie(seed, [_shards(table.orderBy("place").collect())], tokens, hash_bits, min_count)
    if trie.words >= 1 << 31:
        raise ValueError("words are numbered with 31 bits")
    coded = stored(_encode(rows, _shared(spark, trie)), spark, "coded")
    learned = coded.where("learned").select("ids")
    size = min(1 << weight_bits, max(LEAST_SHARD, tokens // (2 * _tasks(spark))))
    for level in range(2, order + 1):
        shared = _shared(spark, trie)
        ranges = spark.sparkContext.broadcast(_ranges(spark, shared, level, size))
        table = stored(_count_level(learned, shared, level, ranges, folder), spark, "lmshards")
        counted = table.orderBy("place").collect()
        shards = _shards(counted)
        trie = Trie(seed, [*trie.levels, shards], tokens, hash_bits, min_count)
        files = stored(_write_values(spark, _shared(spark, trie), level, _edge_masses(counted), folder), spark, "lmvalues")
        named = {r.place: r.path for r in files.collect()}
        shards = [s._replace(values=named[k]) for k, s in enumerate(shards)]
        trie = Trie(seed, [*trie.levels[:-1], shards], tokens, hash_bits, min_count)
    return trie, coded


def _shared(spark: SparkSession, trie: Trie):
    """A few names of files to a shard, not the levels."""
    return spark.sparkContext.broadcast(trie)


def is_held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


def token_logs(trie: Trie, tokens: Tokens) -> np.ndarray:
    """Decimal logarithm of each token's probability after the longest stored context."""
    found = _entries(trie, tokens, len(trie.levels))
    logs = np.full(len(tokens.ids), int(quantised(np.array([trie.unit]))[0]), np.int64)
    known = tokens.ids >= 0
    if known.any():
        logs[known] = _first_log(trie, tokens.ids[known])
    for level in range(2, len(trie.levels) + 1):
        context = np.flatnonzero((found[level - 2][:-1] >= 0) & (tokens.text[1:] == tokens.text[:-1]))
        logs[context + 1] += trie.weight(level - 1, found[level - 2][context])
        hit = np.flatnonzero(found[level - 1] >= 0)
        if len(hit):
            logs[hit] = trie.values(level, "prob", found[level - 1][hit])
    return -logs / STEPS


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, **options) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row."""
    key = F.col(f"`{doc_id}`")
    trie, coded = build(docs.select(
        key.alias("doc_id"), (~is_held_out(key)).alias("learned"), F.col(f"`{text}`").cast("binary").alias("body"),
    ), order, **options)
    shared = _shared(docs.sparkSession, trie)
    rows = coded.select("doc_id", "ids")
    kinds = "n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, base_score DOUBLE, score DOUBLE"
    size = CHUNK_TOKENS * CODED_CHUNK
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), *T.StructType.fromDDL(kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for batch in batches:
            first = 0
            for chunk in _chunks(_coded(batch.column(1)), size):
                tokens = _tokens(chunk)
                n = len(chunk)
                counts = _counts(trie, tokens.ids)
                base = np.log10((counts + 1) * trie.unit)
                made = _batch((
                    np.bincount(tokens.text, minlength=n), np.bincount(tokens.text, counts > 0, n).astype(np.int64),
                    np.full(n, trie.tokens), np.bincount(tokens.text, base, n),
                    np.bincount(tokens.text, token_logs(trie, tokens), n),
                ), kinds)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *made.columns], names=schema.names)
                first += n

    return rows.mapInArrow(run, schema).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score",
    )
