"""Sets of hashed keys as files of bits that tasks read.

A key's bucket is its top bits. The keys of a task are packed into one row per shard, shards are
summed one by one, and a bucket's bit says whether it holds at least so many keys. A bucket may be
shared: a set bit is no proof, an unset one is.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from citeflow.llm.files import attempt_name, make_dir, open_read, open_write
from citeflow.plans.workspace import new_dir

# 128 MB in a Python worker; beyond that, fuller buckets let more keys pass. Buckets of a shard.
MOST_BITS, SHARD_BITS = 30, 20
# Keys that a task packs at a time.
PACKED = 1 << 20

Keys = Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]


class Bits:
    """``key in set`` for arrays of keys; files are read where it is first asked."""

    def __init__(self, bits: int, files: list[tuple[int, str]]):
        self.bits, self.files = bits, files

    def _whole(self) -> np.ndarray:
        name = self.files[0][1]
        if name not in _read:
            size = 1 << (SHARD_BITS - 3)
            whole = np.zeros(max(1 << self.bits >> 3, size), np.uint8)
            for shard, path in self.files:
                with open_read(path) as file:
                    whole[shard * size:(shard + 1) * size] = np.frombuffer(file.read(), np.uint8)
            _read[name] = whole
        return _read[name]

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not self.files:
            return np.zeros(len(keys), bool)
        whole, b = self._whole(), keys >> np.uint64(64 - self.bits)
        return (whole[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 == 1


_read: dict[str, np.ndarray] = {}


def only(*sets: Bits) -> None:
    """What the Python worker has read of other sets goes."""
    names = {s.files[0][1] for s in sets if s.files}
    for name in [n for n in _read if n not in names]:
        del _read[name]


def _packed(buckets: np.ndarray, most: int) -> Iterator[tuple[int, bytes]]:
    """Shard and counts, at most ``most`` each: the buckets' distances in planes of bytes, then the counts."""
    found, counts = np.unique(buckets, return_counts=True)
    shards = found >> np.uint32(SHARD_BITS)
    edges = np.flatnonzero(np.diff(shards, prepend=shards[0] + 1, append=shards[-1] + 1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        gaps = np.diff(found[a:b] & np.uint32((1 << SHARD_BITS) - 1), prepend=np.uint32(0)).astype("<u4")
        body = gaps.view(np.uint8).reshape(-1, 4).T.tobytes() + np.minimum(counts[a:b], most).astype(np.uint8).tobytes()
        yield int(shards[a]), zlib.compress(body, 1)


def _unpacked(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zlib.decompress(body), np.uint8).reshape(5, -1)
    return np.cumsum(np.ascontiguousarray(data[:4].T).view("<u4").ravel()), data[4]


def collect_bits(rows: DataFrame, keys: Keys, room: int, least: int) -> Bits:
    """The buckets, ``room`` or more up to the most, that hold ``least`` keys or more."""
    spark, bits = rows.sparkSession, min(MOST_BITS, max(8, room.bit_length()))
    folder = new_dir(spark, "bits")
    make_dir(f"{folder}/files")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(held: list[np.ndarray]) -> pa.RecordBatch:
            buckets = (np.concatenate(held) >> np.uint64(64 - bits)).astype(np.uint32)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*_packed(buckets, least)), (pa.int32(), pa.binary()))],
                names=["shard", "body"])

        held, size = [], 0
        for found in keys(batches):
            if len(found):
                held.append(found)
                size += len(found)
            if size >= PACKED:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, total = None, None

        def done() -> pa.RecordBatch:
            path = f"{folder}/files/{attempt_name(f'bits-{shard}')}"
            with open_write(path) as file:
                file.write(np.packbits(total >= least, bitorder="little").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([path])], names=["shard", "path"])

        for batch in batches:
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                if k != shard:
                    if shard is not None:
                        yield done()
                    shard, total = k, np.zeros(1 << SHARD_BITS, np.uint8)
                places, counts = _unpacked(body.as_py())
                total[places] = np.minimum(total[places] + counts, least)
        if shard is not None:
            yield done()

    counted = rows.mapInArrow(count, "shard INT, body BINARY").repartition("shard").sortWithinPartitions("shard")
    counted.mapInArrow(add, "shard INT, path STRING").write.parquet(f"{folder}/manifest")
    return Bits(bits, [tuple(r) for r in spark.read.parquet(f"{folder}/manifest").collect()])
