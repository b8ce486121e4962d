"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network in numpy.

1. Every word is followed by a token for its shape (letters, capitals, digits, marks). Tokens fall
   on ``ROWS`` rows by their CRC. Each row has a fixed sparse random index vector; the vector of a
   row is the sum of the index vectors of its neighbours over the whole corpus. A task adds up a
   table of its own and passes it on in blocks, which are added block by block.
2. A document is the mean of its tokens' vectors with its length, the length of that mean and the
   share of distinct tokens.
3. A two-layer network learns from at most about ``SAMPLE_ROWS`` labelled rows; a part of them
   that it has not seen sets the temperature that calibrates its probabilities.

The table (``ROWS`` x ``DIM`` floats, 6 MB) and the network have a fixed size and are sent to all
tasks. Labels, ids and other columns are no input of a score.

Defined results: a null or empty text is pooled to zeros and scored like any other; a null id is
held out; repeated rows get equal scores; labels without a value or a document are not used; with
labels of one class or none the score is their smoothed share; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeflow.llm.graph import stored
from citeflow.llm.words import spaced_words

ROWS = 1 << 15
DIM = 48
DENSITY = 0.1
REACH = 2
SEED = 11
BLOCK_ROWS = 128
CHUNK_TOKENS = 1 << 16
SAMPLE_ROWS = 20_000
HIDDEN = 32
THRESHOLD = 0.3

_SHAPE = bytes(
    97 if b >= 128 or 97 <= b <= 122 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b
    for b in range(256)
)


def index_vectors() -> np.ndarray:
    """Ternary and sparse; the last row, for gaps between texts, is zero."""
    rng = np.random.default_rng(SEED)
    drawn = rng.random((ROWS + 1, DIM))
    table = (drawn < DENSITY / 2).astype(np.int8) - (drawn > 1 - DENSITY / 2).astype(np.int8)
    table[ROWS] = 0
    return table


def token_rows(text: bytes | None) -> np.ndarray:
    """Rows of shapes and words in turn."""
    words, shapes = spaced_words(text), (text or b"").translate(_SHAPE).split()
    rows = np.empty(2 * len(words), np.int64)
    rows[0::2] = np.fromiter(map(crc32, shapes, repeat(1)), np.int64, len(words)) & (ROWS - 1)
    rows[1::2] = np.fromiter(map(crc32, words), np.int64, len(words)) & (ROWS - 1)
    return rows


def _chunks(texts: Iterator[bytes | None]) -> Iterator[np.ndarray]:
    """Rows of several texts, with gaps as wide as the reach; long texts are cut with overlap."""
    gap = np.full(REACH, ROWS, np.int64)
    held, size = [gap], REACH
    for text in texts:
        rows = token_rows(text)
        held += [rows, gap]
        size += len(rows) + REACH
        if size >= CHUNK_TOKENS:
            yield np.concatenate(held)
            held, size = [gap], REACH
    if size > REACH:
        yield np.concatenate(held)


def add_neighbours(table: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """Adds to each token's row the index vectors of the tokens within reach."""
    for first in range(0, len(rows), CHUNK_TOKENS):
        low, high = max(0, first - REACH), min(len(rows), first + CHUNK_TOKENS + REACH)
        near = index[rows[low:high]]
        around = np.zeros(near.shape, np.int16)
        for k in range(1, REACH + 1):
            around[k:] += near[:-k]
            around[:-k] += near[k:]
        here = slice(first - low, min(len(rows), first + CHUNK_TOKENS) - low)
        own = rows[low:high][here]
        order = np.argsort(own, kind="stable")
        sorted_rows = own[order]
        starts = np.flatnonzero(np.concatenate(([True], sorted_rows[1:] != sorted_rows[:-1])))
        table[sorted_rows[starts]] += np.add.reduceat(around[here][order], starts, axis=0, dtype=np.int64)


def word_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Vectors of all rows from the whole corpus: unit length, less their common part."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, table = index_vectors(), np.zeros((ROWS + 1, DIM), np.int64)
        for batch in batches:
            for rows in _chunks(v.as_py() for v in batch.column(0)):
                add_neighbours(table, index, rows)
        yield from blocks(table)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(data.as_py(), "<i8")
                sums[block] = sums[block] + part if block in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                ["block", "sums"],
            )

    def blocks(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        for block in range(ROWS // BLOCK_ROWS):
            part = table[block * BLOCK_ROWS:(block + 1) * BLOCK_ROWS]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int32()), pa.array([part.astype("<i8").tobytes()], pa.binary())],
                    ["block", "sums"],
                )

    kind = "block INT, sums BINARY"
    parts = docs.select(F.col(f"`{text}`").cast("binary")).mapInArrow(partial, kind)
    summed = parts.repartition("block").mapInArrow(total, kind)
    table = np.zeros((ROWS + 1, DIM), np.float64)
    for row in summed.collect():  # at most ROWS / BLOCK_ROWS rows
        table[row.block * BLOCK_ROWS:(row.block + 1) * BLOCK_ROWS] = np.frombuffer(row.sums, "<i8").reshape(-1, DIM)
    norms = np.linalg.norm(table, axis=1, keepdims=True)
    table = np.divide(table, norms, out=np.zeros_like(table), where=norms > 0)
    used = norms[:, 0] > 0
    if used.any():
        table[used] -= table[used].mean(axis=0)
    return table.astype(np.float32)


def pooled(table: np.ndarray, text: bytes | None) -> np.ndarray:
    """A document's features."""
    rows = token_rows(text)
    if not len(rows):
        return np.zeros(DIM + 3, np.float32)
    distinct, times = np.unique(rows, return_counts=True)
    mean = times.astype(np.float32) @ table[distinct] / len(rows)
    extra = [np.log1p(len(rows)), np.linalg.norm(mean), len(distinct) / len(rows)]
    return np.concatenate([mean, extra]).astype(np.float32)


class Network(NamedTuple):
    """Features are scaled, go through one hidden layer, and the logit is divided by a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh((features - self.centre) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -40, 40)))


def constant(share: float, size: int) -> Network:
    """A network without inputs."""
    zero = np.zeros((size, 1))
    return Network(np.zeros(size), np.ones(size), zero, np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def _loss(logits: np.ndarray, truth: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - truth * logits))


def train(features: np.ndarray, truth: np.ndarray, epochs: int = 40, batch: int = 128,
          rate: float = 3e-3, decay: float = 1e-3) -> Network:
    """Adam on four fifths of the rows; the rest chooses the epoch and the temperature."""
    size = features.shape[1] if features.ndim == 2 and len(features) else DIM + 3
    if len(truth) < 10 or len(set(truth.tolist())) < 2:
        return constant((truth.sum() + 1) / (len(truth) + 2), size)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(truth))
    held, used = order[: len(order) // 5], order[len(order) // 5:]
    centre, scale = features[used].mean(axis=0), features[used].std(axis=0) + 1e-6
    scaled = ((features - centre) / scale).astype(np.float64)
    weights = [rng.normal(0, size ** -0.5, (size, HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    best, step = (np.inf, weights), 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(used), max(1, len(used) // batch)):
            x, y = scaled[rows], truth[rows]
            hidden = np.tanh(x @ weights[0] + weights[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -40, 40))) - y) / len(rows)
            back = np.outer(error, weights[2]) * (1 - hidden**2)
            slopes = [x.T @ back + decay * weights[0], back.sum(axis=0),
                      hidden.T @ error + decay * weights[2], np.array([error.sum()])]
            step += 1
            for k, slope in enumerate(slopes):
                mean, square = moments[k]
                mean += 0.1 * (slope - mean)
                square += 0.001 * (slope**2 - square)
                weights[k] = weights[k] - rate * (mean / (1 - 0.9**step)) / (
                    np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        hidden = np.tanh(scaled[held] @ weights[0] + weights[1])
        loss = _loss(hidden @ weights[2] + weights[3], truth[held])
        if loss < best[0]:
            best = (loss, [w.copy() for w in weights])
    first, first_bias, second, second_bias = best[1]
    network = Network(centre, scale, first, first_bias, second, float(second_bias[0]))
    logits = network.logits(features[held])
    choices = np.geomspace(0.25, 8, 81)
    return network._replace(temperature=float(choices[np.argmin([_loss(logits / t, truth[held]) for t in choices])]))


def is_held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(word_table(docs, text))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("body"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType),
                           T.StructField("features", T.BinaryType())])

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            made = [pooled(table, v.as_py()).tobytes() for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=schema.names)

    vectors = stored(rows.mapInArrow(pool, schema), spark, "vectors")
    known = labels.select(F.col("doc_id").alias("_id"), F.col(f"`{label}`").cast("double").alias("truth"))
    learned = vectors.where(~is_held_out(F.col("doc_id"))).join(
        known.where("truth IS NOT NULL"), F.col("doc_id") == F.col("_id")
    ).select("doc_id", "features", "truth")
    total = learned.count()
    part = F.expr("pmod(xxhash64(doc_id, 'sample'), 1000000)") < int(1e6 * min(1.0, sample_rows / max(1, total)))
    sample = learned.where(part).select("features", "truth").limit(2 * sample_rows).collect()
    sample.sort(key=lambda r: (bytes(r.features), r.truth))
    features = np.array([np.frombuffer(r.features, np.float32) for r in sample])
    network = train(features, np.array([r.truth for r in sample]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                stacked = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(batch.num_rows, -1)
                found = pa.array(network.probabilities(stacked), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "score"])

    judged = T.StructType([schema["doc_id"], T.StructField("score", T.DoubleType())])
    return vectors.mapInArrow(judge, judged).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
