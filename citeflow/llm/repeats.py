"""Long repeated byte strings, removed: every byte covered by a ``length``-byte string that also
starts somewhere else, in the same text or another.

The method first dealt for this operator is a run-length Burrows-Wheeler index of the whole
corpus with matching statistics streamed against it. That index is one sequential structure over
all bytes, and its construction (a suffix sort of the corpus) is not partitioned work; this
module finds the same strings exactly with aggregates and joins instead (see the README):

1. Anchors. Of the ``length - k + 1`` blocks of ``k`` bytes in each window of ``length`` bytes, the
   one of the least hash (the leftmost of them) is the window's anchor (winnowing). Equal windows
   have equal anchors at equal offsets. Neighbouring windows with the same anchor are a piece.
2. A piece has a core, the bytes that all its windows share (here the anchor), and a hull, the
   bytes that any of them covers. A core that occurs once has no repeated window: cores are
   counted in hashed buckets, and pieces whose bucket holds one are left out. A bucket only
   overestimates, so no repeated window is lost.
3. Pieces left are counted by core and hull, with partial sums, so a frequent one costs a row per
   task. Those that occur twice or more are repeated: all their windows go.
4. Where a core has hulls that occur once beside others, one piece of each hull is cut in pieces of
   fewer windows (by the anchor's offset), whose cores are longer, and steps 2 and 3 are done
   again: first with about the root of ``length - k + 1`` windows each, then with one, where core
   and hull are the window itself and nothing is left open.

A row is a piece, about one in 65 bytes of text near repeated anchors; only windows at the edges of
a repeated string become rows of their own. A string held by thousands of texts is one aggregate
key, never a group of pairs. The texts are scanned and hashed again for each step, so that no row
of what is left out is kept.

Defined results: a null text is empty; a text shorter than ``length`` bytes loses nothing; repeated
rows of ``length`` bytes or more remove each other whole; a null id is an id like any other; an
empty table gives an empty table; extra columns are ignored. Cores and hulls are compared by two
64-bit hashes: two different pieces with one anchor share them with a probability near 2^-64.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeflow.llm.bits import Bits, collect_bits, only
from citeflow.llm.graph import stored

LENGTH = 200
K = 32

# Windows of a text taken at a time, always from the same places of it, and bytes of texts.
CHUNK, GROUP_BYTES = 1 << 16, 1 << 17
# Bytes of texts that are cut at a time.
CUT_BYTES = 1 << 22
# Rows that a task sums up or merges at a time.
ROWS = 1 << 17
# Bytes of text for each bucket of anchors, and buckets for each piece to be cut.
ANCHOR_BYTES, PIECE_BUCKETS = 4, 32

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(0, 2**63, size=256, dtype=np.uint64)
_MULT = _RNG.integers(1, 2**63, size=(4, 256), dtype=np.uint64) | np.uint64(1)
# A place in a group is the low bits of what is compared; the hash's other bits come first.
_LOW = np.uint64((1 << 20) - 1)


def _fold(one: np.ndarray, two: np.ndarray, mult: np.uint64) -> np.ndarray:
    h = one * mult
    h += two
    h ^= h >> np.uint64(32)
    return h


def block_hashes(data: np.ndarray, k: int = K) -> np.ndarray:
    """64-bit hash of each ``k``-byte substring, in order; each from two that cover it."""
    if len(data) < k:
        return np.zeros(0, np.uint64)
    h, span, t = _BYTE[data], 1, 0
    while span < k:
        step = min(span, k - span)
        h = _fold(h[:len(h) - step], h[step:], _MULT[0, t])
        span, t = span + step, t + 1
    h *= _MULT[0, t]
    h ^= h >> np.uint64(29)
    return h


def _prints(h: np.ndarray, starts: np.ndarray, size: int, k: int, lane: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each start, from blocks that cover them."""
    offsets = list(range(0, size - k + 1, k))
    if offsets[-1] != size - k:
        offsets.append(size - k)
    out = np.zeros(len(starts), np.uint64)
    for t, o in enumerate(offsets):
        out ^= h[starts + o]
        out *= _MULT[lane, t % 256]
        out ^= out >> np.uint64(32)
    return out


def _least(a: np.ndarray, w: int) -> np.ndarray:
    """Least of each run of ``w`` values."""
    n, span = len(a) - w + 1, 1
    while span * 2 <= w:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    return np.minimum(a[:n], a[w - span:w - span + n])


class _Pieces(NamedTuple):
    """First window, number of windows, anchor's place and its offset by grid, by piece."""

    first: np.ndarray
    n: np.ndarray
    at: np.ndarray
    grid: np.ndarray

    def where(self, kept: np.ndarray) -> _Pieces:
        return _Pieces(*(c[kept] for c in self))

    def cut(self, size: int) -> _Pieces:
        """In pieces whose windows' anchor offsets lie in one of the ranges of ``size`` offsets."""
        most = self.at - self.first
        least, top = most - self.n + 1, most // size
        parts = top - least // size + 1
        of = np.repeat(np.arange(len(parts)), parts)
        grid = top[of] - (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts))
        hi, lo = np.minimum(most[of], grid * size + size - 1), np.maximum(least[of], grid * size)
        return _Pieces(self.at[of] - hi, hi - lo + 1, self.at[of], grid)


def _pieces(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int, k: int) -> _Pieces:
    """Pieces of the windows that start from ``lo`` to before ``hi`` in the bytes hashed."""
    w = length - k + 1
    key = h & ~_LOW
    key |= np.arange(len(h), dtype=np.uint64)
    at = (_least(key, w) & _LOW).astype(np.int64)
    inside = np.zeros(len(at) + 1, np.int8)
    np.add.at(inside, lo, 1)
    np.add.at(inside, hi, -1)
    begins = np.ones(len(at), bool)
    np.not_equal(at[1:], at[:-1], out=begins[1:])
    begins &= np.cumsum(inside[:-1], dtype=np.int8) > 0
    begins[lo] = True
    first = np.flatnonzero(begins)
    end = np.minimum(np.append(first[1:], len(at)), hi[np.searchsorted(lo, first, "right") - 1])
    return _Pieces(first, end - first, at[first], np.zeros(len(first), np.int64))


class _Group(NamedTuple):
    """Bytes of some texts, hashed, and for each chunk of windows its row, place there and in the text."""

    hashes: np.ndarray
    rows: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    text: np.ndarray

    def begins(self, pieces: _Pieces) -> tuple[np.ndarray, np.ndarray]:
        """Row of each piece and its first window's place in the text."""
        of = np.searchsorted(self.lo, pieces.first, "right") - 1
        return self.rows[of], self.text[of] + pieces.first - self.lo[of]


def _groups(bodies: pa.Array, length: int, k: int) -> Iterator[_Group]:
    """Texts side by side, long ones in chunks; where a chunk begins hangs on its text alone."""
    bodies = bodies.cast(pa.large_binary())
    ends = np.frombuffer(bodies.buffers()[1], np.int64)[bodies.offset:bodies.offset + len(bodies) + 1]
    if not len(bodies) or ends[-1] == ends[0]:
        return
    data = np.frombuffer(bodies.buffers()[2], np.uint8)
    windows = np.maximum(0, np.diff(ends) - length + 1)
    parts = -(-windows // CHUNK)
    rows = np.repeat(np.arange(len(parts)), parts)
    text = (np.arange(len(rows)) - np.repeat(np.cumsum(parts) - parts, parts)) * CHUNK
    lo = ends[:-1][rows] + text
    hi = lo + np.minimum(CHUNK, windows[rows] - text)
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(hi, lo[at] + GROUP_BYTES, "right")))
        base = lo[at]
        yield _Group(block_hashes(data[base:hi[to - 1] + length - 1], k), rows[at:to], lo[at:to] - base,
                     hi[at:to] - base, text[at:to])
        at = to


def anchors(data: bytes, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors: the least block hash of any run that fits a string."""
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for group in _groups(pa.array([data]), length, k):
        at = np.unique(_pieces(group.hashes, group.lo, group.hi, length, k).at)
        places.append(at - group.lo[0] + group.text[0])
        hashes.append(group.hashes[at])
    places, one = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(hashes)[one]


class _Level(NamedTuple):
    """Windows in a piece at most, and which of these pieces are cut for the next level."""

    size: int
    chosen: Bits


class _Found(NamedTuple):
    """Core, hull, text key, first window and number of windows, by piece; all of 64 bits."""

    core: np.ndarray
    hull: np.ndarray
    h: np.ndarray
    h2: np.ndarray
    first: np.ndarray
    n: np.ndarray

    def ids(self) -> np.ndarray:
        """The place's hash: equal for copies of a text."""
        return _fold(_fold(self.h, self.h2, _MULT[3, 0]), self.first.astype(np.uint64), _MULT[3, 1]) * _MULT[3, 2]


def _scan(batches: Iterator[pa.RecordBatch], above: list[_Level], size: int, cores: Bits | None, length: int,
          k: int) -> Iterator[_Found]:
    """Pieces of at most ``size`` windows from those chosen above; without ``cores`` only these are filled."""
    only(*(level.chosen for level in above), *([cores] if cores else []))
    for batch in batches:
        keys = [batch.column(i).to_numpy().view(np.uint64) for i in (1, 2)]
        for group in _groups(batch.column(0), length, k):
            h = group.hashes
            pieces = _pieces(h, group.lo, group.hi, length, k)
            for level in above:
                pieces = pieces.cut(level.size)
                pieces = pieces.where(level.chosen.has(_described(group, pieces, keys).ids()))
            pieces = pieces.cut(size)
            core = _prints(h, pieces.at - pieces.grid * size, length - size + 1, k, 1)
            core = _fold(core, h[pieces.at] + pieces.grid.astype(np.uint64), _MULT[3, 3]) * _MULT[3, 4]
            if cores is None:
                yield _Found(core, *[core[:0]] * 5)
                continue
            kept = cores.has(core)
            core, pieces = core[kept], pieces.where(kept)
            hull = _fold(_prints(h, pieces.first, length, k, 2),
                         _prints(h, pieces.first + pieces.n - 1, length, k, 2), _MULT[3, 5])
            range_ = (pieces.at - pieces.first) * length + pieces.n
            yield _described(group, pieces, keys, core, _fold(hull, range_.astype(np.uint64), _MULT[3, 6]))


def _described(group: _Group, pieces: _Pieces, keys: list[np.ndarray], core=None, hull=None) -> _Found:
    rows, first = group.begins(pieces)
    return _Found(core, hull, keys[0][rows], keys[1][rows], first, pieces.n)


def _together(found: Iterator[_Found]) -> Iterator[_Found]:
    held, size = [], 0
    for one in found:
        held.append(one)
        size += len(one.core)
        if size >= ROWS:
            yield _Found(*map(np.concatenate, zip(*held)))
            held, size = [], 0
    if size:
        yield _Found(*map(np.concatenate, zip(*held)))


def _alike(found: _Found) -> tuple[np.ndarray, np.ndarray]:
    """The order by core and hull, and where in it each pair begins."""
    order = np.lexsort((found.hull, found.core))
    core, hull = found.core[order], found.hull[order]
    return order, np.flatnonzero(np.append(True, (core[1:] != core[:-1]) | (hull[1:] != hull[:-1])))


def _summed(found: _Found) -> pa.RecordBatch:
    """``core, hull, n, id``: pieces of each core and hull, and the least place's hash."""
    order, begins = _alike(found)
    n, ids = np.diff(np.append(begins, len(order))), found.ids()[order].view(np.int64)
    first = order[begins]
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in (found.core[first].view(np.int64), found.hull[first].view(np.int64), n,
                               np.minimum.reduceat(ids, begins))], names=["core", "hull", "n", "id"])


def _span(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    return first * (1 << 31) + n


def _placed(found: _Found) -> pa.RecordBatch:
    """``core, hull, h, h2, span, sure``: neighbours already seen twice are sure, and merged."""
    order, begins = _alike(found)
    often = np.repeat(np.diff(np.append(begins, len(order))) > 1, np.diff(np.append(begins, len(order))))
    sure = np.empty(len(order), bool)
    sure[order] = often
    h, h2, first, n = found.h, found.h2, found.first, found.n
    on = sure[1:] & sure[:-1] & (h[1:] == h[:-1]) & (h2[1:] == h2[:-1]) & (first[1:] == first[:-1] + n[:-1])
    at = np.flatnonzero(np.append(True, ~on))
    cols = [c[at].view(np.int64) for c in (found.core, found.hull, h, h2)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in (*cols, _span(first[at], np.add.reduceat(n, at)), sure[at])],
        names=["core", "hull", "h", "h2", "span", "sure"])


def _key(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, body, h, h2``: the text's bytes and 96 bits of hash of them, its key."""
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"").cast("binary"))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body.alias("body"))
    return rows.withColumns({"h": F.xxhash64("body"), "h2": F.crc32("body")})


def _repeated(rows: DataFrame, above: list[_Level], size: int, room: int, length: int, k: int) -> tuple[DataFrame, DataFrame]:
    """``h, h2, span`` of the repeated pieces of a level, and its ``core, hull, n, id``."""
    spark = rows.sparkSession

    def cores_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        return (found.core for found in _scan(batches, above, size, None, length, k))

    cores = collect_bits(rows, cores_of, room, 2)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(_summed, _together(_scan(batches, above, size, cores, length, k)))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(_placed, _together(_scan(batches, above, size, cores, length, k)))

    counted = rows.mapInArrow(sums, "core BIGINT, hull BIGINT, n BIGINT, id BIGINT").groupBy("core", "hull")
    kinds = stored(counted.agg(F.sum("n").alias("n"), F.min("id").alias("id")), spark, "kinds")
    placed = rows.mapInArrow(places, "core BIGINT, hull BIGINT, h BIGINT, h2 BIGINT, span BIGINT, sure BOOLEAN")
    twice = kinds.where("n >= 2").select("core", "hull", F.lit(True).alias("twice"))
    spans = placed.join(twice, ["core", "hull"], "left").where("sure or twice").select("h", "h2", "span")
    return spans, kinds


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
             k: int = K) -> DataFrame:
    """``h, h2, spans``: runs of repeated windows of each distinct text that has any, each as its
    first window's start times 2^31 and the number of windows.
    """
    rows = _key(docs, doc_id, text).select("body", "h", "h2")
    room = (rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0) // ANCHOR_BYTES
    w, above, found = length - k + 1, [], None
    for size in sorted({w, math.isqrt(w), 1}, reverse=True):
        spans, kinds = _repeated(rows, above, size, room, length, k)
        found = spans if found is None else found.union(spans)
        if size == 1:  # a core is a window: there is nothing to cut
            break
        mixed = kinds.groupBy("core").agg(F.sum("n").alias("all"), F.min("n").alias("least"))
        mixed = mixed.where("least = 1 and all >= 2").select("core")
        room = PIECE_BUCKETS * kinds.count()
        chosen = collect_bits(
            kinds.join(mixed, "core", "left_semi").select("id"),
            lambda batches: (b.column(0).to_numpy().view(np.uint64) for b in batches), room, 1)
        if not chosen.files:  # no hull is left open
            break
        above = [*above, _Level(size, chosen)]
    return found.groupBy("h", "h2").agg(F.collect_set("span").alias("spans"))


def _spans(runs: list[int], length: int) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for run in sorted(runs):
        s, n = divmod(run, 1 << 31)
        e = s + n - 1 + length
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    return [(a, b) for a, b in spans]


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
          k: int = K) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the remaining bytes) of every row."""
    rows = _key(docs, doc_id, text)
    marked = removals(docs, doc_id, text, length, k)
    joined = rows.join(marked, ["h", "h2"], "left").select("doc_id", "body", "spans")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few rows at a time: beside the batch, a task holds the bytes of those only.
            step = max(1, batch.num_rows * CUT_BYTES // max(1, batch.nbytes))
            for part in (batch.slice(first, step) for first in range(0, batch.num_rows, step)):
                out = {f.name: [] for f in schema}
                for d, body, runs in zip(*(part.column(i).to_pylist() for i in range(3))):
                    spans = _spans(runs or [], length)
                    pieces, at = [], 0
                    for a, b in spans:
                        pieces.append(body[at:a])
                        at = b
                    pieces.append(body[at:])
                    kept = b"".join(pieces)
                    out["doc_id"].append(d)
                    out["n_bytes"].append(len(body))
                    out["n_removed"].append(len(body) - len(kept))
                    out["n_spans"].append(len(spans))
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    out["kept"].append(kept)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                    [(f.name, t) for f, t in zip(schema, (pa.int64(),) * 4 + (pa.string(), pa.binary()))]))

    return joined.mapInArrow(cut, schema)
