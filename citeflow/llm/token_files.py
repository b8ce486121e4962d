"""Token ids in flat files, with 64-bit document offsets, in the order of document ids.

A data set is a manifest (Parquet) and, for each shard, three little-endian files: token ids as
unsigned 16- or 32-bit integers (whichever the vocabulary needs), ``n + 1`` unsigned 64-bit offsets
of documents in that file, and ``n`` signed 64-bit document ids. Shards are ranges of document
ids; prefix sums over the manifest give each shard's first token and document in the whole set.
Readers map the files.

Defined results: a null text is empty and holds the end id alone; null ids come first (the first
``null_ids`` rows of the manifest's shard, 0 in the file) and are null again when read; rows of
the same id stand together in the order of a hash of their text, each a document of its own; an
empty table gives a manifest without rows.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow.llm.files import attempt_name, make_dir, open_read, open_write

END_ID = 2
# Parts of words kept between texts by a worker, twice as many at most, about 200 bytes each.
CACHED_PIECES = 300_000
MAX_CACHED_CHARS = 48
# Text encoded at a time: its words are looked up once each.
GROUP_BYTES = 1 << 22
# Tokens read from a map at a time.
READ_TOKENS = 1 << 20

# Texts with white space about which libraries differ are encoded whole.
_RARE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")

MANIFEST = "shard INT, path STRING, width INT, docs BIGINT, tokens BIGINT, null_ids BIGINT"


# Two blanks in a row, where the vocabulary's splitting depends on the first of them.
_ODD = ("  ", " \n", "\n ", "\t", "\r")
_PIECE = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
# Marks after a letter (ASCII, no apostrophe) are ids of their own.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTERS = pa.array([c for c in map(chr, range(65, 256)) if c.isalpha() and c not in "ªµº"])


def _listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def _runs(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[begin:begin + size]`` of each run, one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Token ids of whole texts as bytes; parts of words that come again are encoded once.

    The vocabulary splits texts before its merges, and never joins a character that is no white
    space to a blank after it. So the pieces between single blanks can be encoded apart, each
    with the blank before it. A single line end between other characters is an id of its own and
    what follows is split as at the start of a text; where a vocabulary does otherwise, pieces with
    line ends are encoded whole.
    """

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        # A text that holds an added token's name is encoded whole, as the library splits it there.
        names = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()}, key=len)
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        # Places of the parts in ``ids``: a part after a blank, or after a line end ("\n" + part).
        # Those of late, and those of before, which are forgotten next.
        self.known, self.older = self._none(), self._none()
        self.tails: dict[str, np.ndarray] = {"": np.zeros(0, self.dtype)}
        self.line = np.array(self._ids("\n"), self.dtype)
        self.lines = len(self.line) == 1 and all(
            self._ids(f"{x}\n{y}") == [*self._ids(x), *self.line.tolist(), *self._ids(y)]
            for x in ("a", " a.", "1", "é") for y in ("B", ".b", "'s", "2", "é")
        )
        # Ids whose token begins with a blank, as a byte-level vocabulary writes it.
        self.starts = np.zeros(1 + max(self.tokenizer.get_vocab().values(), default=0), bool)
        self.starts[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith("Ġ")]] = True

    def _encode(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        if sys.byteorder == "little":
            return [array(self.code, e.ids).tobytes() for e in found]
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _none(self) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
        """Parts by number, their ids one after the other, and where each part's begin."""
        return {}, np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def _joined(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        return np.frombuffer(b"".join(found), self.dtype), sizes

    def _encode_parts(self, parts: list[str], before: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``before + part`` for each part, or of the part alone if ``before`` is a line end,
        and how many. Parts without white space are encoded in one text and told apart by the ids
        that begin with a blank, or that are line ends; else one by one."""
        joined = before.join(parts)
        if joined.split() == parts and not (self.added is not None and self.added.search(joined)):
            text = joined if before == "\n" else before + joined
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            if before == "\n":
                ends = np.flatnonzero(ids == self.line[0])
                if len(ends) == len(parts) - 1:
                    return np.delete(ids, ends), np.diff(np.r_[-1, ends, len(ids)]) - 1
            else:
                cuts = np.flatnonzero(self.starts[ids])
                if len(cuts) == len(parts) and cuts[0] == 0:
                    return ids, np.diff(np.r_[cuts, len(ids)])
        return self._joined(self._encode(parts if before == "\n" else [before + p for p in parts]))

    def _learn(self, new: list[str]) -> None:
        """Puts parts that are not known there, from the older ones or the vocabulary."""
        if not new:
            return
        known, ids, begins = self.known
        older, old_ids, old_begins = self.older
        places = np.fromiter(map(older.get, new, repeat(-1)), np.int64, len(new))
        kinds = [[p for p, at in zip(new, places.tolist()) if at >= 0], [], []]
        for p, at in zip(new, places.tolist()):
            if at < 0:
                kinds[1 + (p[:1] == "\n")].append(p)
        places = places[places >= 0]
        sizes = old_begins[places + 1] - old_begins[places]
        gained = [(_runs(old_ids, old_begins[places], sizes), sizes)]
        for parts, before in ((kinds[1], " "), ([p[1:] for p in kinds[2]], "\n")):
            if parts:
                gained.append(self._encode_parts(parts, before))
        count = len(begins) - 1
        known.update(zip([p for parts in kinds for p in parts], range(count, count + len(new))))
        ends = begins[-1] + np.cumsum(np.concatenate([n for _, n in gained]))
        self.known = known, np.concatenate([ids, *(g for g, _ in gained)]), np.concatenate([begins, ends])

    def _parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and each part's begin and size in them; the parts are distinct."""
        places = np.fromiter(map(self.known[0].get, parts, repeat(-1)), np.int64, len(parts))
        missed = np.flatnonzero(places < 0)
        if len(self.known[0]) + len(missed) > CACHED_PIECES:
            self.known, self.older, missed = self._none(), self.known, np.arange(len(parts))
        new = [parts[k] for k in missed.tolist()]
        far = [p for p in new if len(p) > MAX_CACHED_CHARS]
        self._learn([p for p in new if len(p) <= MAX_CACHED_CHARS] if far else new)
        kept = len(self.known[0])
        if far:  # last, and forgotten at once
            self._learn(far)
        known, ids, begins = self.known
        places[missed] = np.fromiter(map(known.__getitem__, new), np.int64, len(new))
        for p in far:
            del known[p]
        self.known = known, ids[:begins[kept]], begins[:kept + 1]
        return ids, begins[places], begins[places + 1] - begins[places]

    def _after_blank(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece with a blank before it, one after the other, and how many."""
        cut = pc.split_pattern(pieces, "\n")
        counts = np.diff(cut.offsets.to_numpy()).astype(np.int64)
        parts = cut.flatten()
        owner = np.repeat(np.arange(len(pieces)), counts)
        whole = np.zeros(len(pieces), bool)
        whole[owner[pc.equal(pc.binary_length(parts), 0).to_numpy(zero_copy_only=False)]] = True
        if not self.lines:
            whole |= counts > 1
        far_ids, far_sizes = self._joined(self._encode([" " + p for p in pieces.filter(pa.array(whole)).to_pylist()]))
        near = ~whole[owner]
        parts, owner = parts.filter(pa.array(near)), owner[near]
        first = np.r_[True, owner[1:] != owner[:-1]][:len(owner)]
        # A part that ends in a letter and then marks is two.
        bare = pc.utf8_rtrim(parts, characters=_MARKS)
        two = pc.and_(pc.not_equal(pc.binary_length(bare), pc.binary_length(parts)),
                      pc.is_in(pc.utf8_slice_codeunits(bare, -1), value_set=_LETTERS.cast(parts.type)))
        base = pc.if_else(two, bare, parts)
        kind = pc.if_else(pa.array(first, pa.bool_()), "", "\n").cast(parts.type)
        coded = pc.binary_join_element_wise(kind, base, pa.scalar("", parts.type)).dictionary_encode()
        ids, begins, sizes = self._parts(_listed(coded.dictionary))
        places = coded.indices.to_numpy()
        # The marks' ids.
        marked = np.flatnonzero(two.to_numpy(zero_copy_only=False))
        tails = [part[len(start):] for part, start in zip(_listed(parts.filter(two)), _listed(bare.filter(two)))]
        names = ["", *set(tails)]
        asked = [t for t in names if t not in self.tails]
        if len(self.tails) + len(asked) > CACHED_PIECES:
            self.tails, asked = {"": self.tails[""]}, [t for t in names if t]
        for t, found in zip(asked, self._encode(asked)):
            self.tails[t] = np.frombuffer(found, self.dtype)
        tail_ids = [self.tails[t] for t in names]
        number = {t: k for k, t in enumerate(names)}
        tail_at = np.zeros(len(parts), np.int64)
        tail_at[marked] = np.fromiter(map(number.__getitem__, tails), np.int64, len(tails))
        tail_sizes = np.fromiter(map(len, tail_ids), np.int64, len(tail_ids))
        tail_begins = np.cumsum(tail_sizes) - tail_sizes
        # Each part: its line end, itself, its marks.
        flat = np.concatenate([self.line, ids, *tail_ids])
        at = np.stack([np.zeros(len(parts), np.int64), begins[places] + len(self.line),
                       tail_begins[tail_at] + len(self.line) + len(ids)], 1).ravel()
        many = np.stack([np.where(first, 0, len(self.line)), sizes[places], tail_sizes[tail_at]], 1)
        near_ids = _runs(flat, at, many.ravel())
        near_sizes = np.bincount(owner, many.sum(1), len(pieces)).astype(np.int64)
        # Pieces encoded whole stand between the others.
        if not len(far_sizes):
            return near_ids, near_sizes
        out = near_sizes.copy()
        out[whole] = far_sizes
        starts = np.cumsum(near_sizes) - near_sizes
        starts[whole] = len(near_ids) + np.cumsum(far_sizes) - far_sizes
        return _runs(np.concatenate([near_ids, far_ids]), starts, out), out

    def _whole(self, text: str) -> bool:
        return bool(_RARE.search(text) or (self.added is not None and self.added.search(text)))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text, null as empty, in groups of texts."""
        step = max(1, len(texts) * GROUP_BYTES // max(1, texts.nbytes))
        for first in range(0, len(texts), step):
            yield from self._encode_group(texts.slice(first, step))

    def _encode_group(self, texts: pa.Array) -> list[bytes]:
        """As :meth:`encode`, but a word that comes again in the group is looked up once."""
        texts = texts.fill_null("")
        bodies = texts.to_pylist()
        plain = [not any(odd in t for odd in _ODD) and not self._whole(t) for t in bodies]
        pieces = pc.split_pattern(texts.filter(pa.array(plain, pa.bool_())), " ")
        if not len(pieces):
            return [self.encode(t) for t in bodies]
        offsets = pieces.offsets.to_numpy().astype(np.int64)
        coded = pieces.flatten().dictionary_encode()
        places, firsts = coded.indices.to_numpy(), offsets[:-1] - offsets[0]
        heads = iter(self._encode(coded.dictionary.take(coded.indices.take(pa.array(firsts))).to_pylist()))
        ids, sizes = self._after_blank(coded.dictionary)
        begins = np.cumsum(sizes) - sizes
        # A text's first piece has no blank before it; its ids are its head.
        taken = sizes[places]
        taken[firsts] = 0
        ends = np.cumsum(taken)
        data = _runs(ids, begins[places], taken).tobytes()
        bounds = np.concatenate([[0], ends])[offsets - offsets[0]] * self.dtype.itemsize
        tails = (data[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()))
        return [next(heads) + next(tails) if ok else self.encode(t) for t, ok in zip(bodies, plain)]

    def encode(self, text: str) -> bytes:
        if self._whole(text):
            return self._encode([text])[0]
        if any(odd in text for odd in _ODD):
            pieces = _PIECE.findall(text)
            plain = [len(p) > 1 and p[0] == " " and p[1] not in " \n\t\r" for p in pieces]
            near = iter(self._one_by_one([p[1:] for p, ok in zip(pieces, plain) if ok]))
            rest = iter(self._encode([p for p, ok in zip(pieces, plain) if not ok]))
            return b"".join([next(near if ok else rest) for ok in plain])
        first, *pieces = text.split(" ")
        return b"".join([*self._encode([first]), *self._one_by_one(pieces)])

    def _one_by_one(self, pieces: list[str]) -> list[bytes]:
        ids, sizes = self._after_blank(pa.array(pieces, pa.string()))
        data, bounds = ids.tobytes(), np.concatenate([[0], np.cumsum(sizes)]) * self.dtype.itemsize
        return [data[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


_encoders: dict[str, Encoder] = {}


def encoder(tokenizer_file: str) -> Encoder:
    """One for each Python worker."""
    if tokenizer_file not in _encoders:
        _encoders[tokenizer_file] = Encoder(tokenizer_file)
    return _encoders[tokenizer_file]


def write(docs: DataFrame, path: str, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text",
          end_id: int = END_ID) -> DataFrame:
    """Encodes and writes all documents below ``path``; gives the manifest.

    One shuffle, of ids and texts, into ranges of ids. A task writes its range as it encodes it.
    """
    spark = docs.sparkSession
    folder = f"{path}/files"
    make_dir(folder)
    # The place of a row in the input splits rows that agree in everything.
    keyed = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"),
        F.xxhash64(f"`{text}`").alias("h"), F.monotonically_increasing_id().alias("place"),
    )
    order = [F.col("id").asc_nulls_first(), F.col("h"), F.col("place")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_file)
        width = coder.dtype.itemsize
        end = np.array([end_id], coder.dtype).tobytes()
        shard, name = None, f"{folder}/{attempt_name('tokens')}"
        at, nulls, offsets, ids = 0, 0, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if shard is None:
                shard = open_write(f"{name}.bin")
            nulls += batch.column(0).null_count
            ids.append(batch.column(0).fill_null(0).to_numpy().astype("<i8"))
            sizes = []
            for body in coder.encode_all(batch.column(1)):
                encoded = body + end
                shard.write(encoded)
                sizes.append(len(encoded) // width)
            ends = at + np.cumsum(np.array(sizes, "<u8"), dtype="<u8")
            offsets.append(ends)
            at = int(ends[-1])
        if shard is None:
            return
        shard.close()
        with open_write(f"{name}.idx") as file:
            file.write(np.concatenate([np.zeros(1, "<u8"), *offsets]).tobytes())
        all_ids = np.concatenate(ids)
        with open_write(f"{name}.ids") as file:
            file.write(all_ids.tobytes())
        number = int(name.rsplit("-", 2)[1])
        row = ([number], [name], [width], [len(all_ids)], [at], [nulls])
        types = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(row, types)],
            ["shard", "path", "width", "docs", "tokens", "null_ids"],
        )

    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest")
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Shards with ``first_doc`` and ``first_token``: prefix sums over one row per shard."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.parquet(f"{path}/manifest").select(
        "*", F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("first_doc"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first_token"),
    )


def documents_of(path: str, width: int, docs: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """``id, offset, tokens`` of each document of a shard, from mapped files."""
    dtype = np.dtype(f"<u{width}")
    with open_read(f"{path}.bin") as tokens, open_read(f"{path}.idx") as index, open_read(f"{path}.ids") as ids:
        step = 1 << 16
        for first in range(0, docs, step):
            n = min(step, docs - first)
            bounds = np.frombuffer(index.read_at((n + 1) * 8, first * 8), "<u8")
            names = np.frombuffer(ids.read_at(n * 8, first * 8), "<i8")
            for k in range(n):
                start, end = int(bounds[k]), int(bounds[k + 1])
                yield int(names[k]), start, np.frombuffer(
                    tokens.read_at((end - start) * width, start * width), dtype
                )


def read(shards: DataFrame, visit: Callable[[np.ndarray], object], column: str, kind: str,
         arrow: pa.DataType) -> DataFrame:
    """``doc_id, start, n_tokens`` and what ``visit`` makes of the tokens, a task per shard."""
    spread = shards.select("path", "width", "docs", "null_ids", "first_token").repartition(
        max(1, shards.count())
    )

    def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
        for row in batch.to_pylist():
            for n, (doc, start, tokens) in enumerate(documents_of(row["path"], row["width"], row["docs"])):
                yield (None if n < row["null_ids"] else doc, row["first_token"] + start, len(tokens), visit(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.int64(), arrow)
        names = ["doc_id", "start", "n_tokens", column]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            held, size = [], 0
            for row in rows_of(batch):
                held.append(row)
                size += row[2]
                if size >= READ_TOKENS:
                    yield made(held)
                    held, size = [], 0
            if held:
                yield made(held)

    return spread.mapInArrow(run, f"doc_id BIGINT, start BIGINT, n_tokens BIGINT, {column} {kind}")


def read_checksums(shards: DataFrame) -> DataFrame:
    """``ids_crc32`` of each document's ids as little-endian unsigned 32-bit integers."""
    return read(
        shards, lambda t: zlib.crc32(t.astype("<u4").tobytes()), "ids_crc32", "BIGINT", pa.int64()
    )


def read_tokens(shards: DataFrame) -> DataFrame:
    """``tokens`` of each document."""
    return read(shards, lambda t: t.astype(np.int32), "tokens", "ARRAY<INT>", pa.list_(pa.int32()))
