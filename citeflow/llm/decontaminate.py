"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds all word sequences of a block of items. A document's words are streamed
through it; after each word it knows the longest sequence of items that ends there. A length of
ten or more means that a window of ten item words ends there; an item of fewer words is a window
itself and is marked on its state. Only runs of words whose neighbours are also neighbours in some
item are streamed: elsewhere no match is longer than one word.

Items are dealt into blocks of a bounded number of words (``BLOCK_WORDS``, checked); long items
are cut into chunks that overlap by nine words, which loses no window. A block is built on the
driver and broadcast; with several blocks the documents pass them one after another, and what was
found is kept with the row. Documents are never shuffled.

Defined results: a null or empty text has no words and no hits; items without words have no
windows; a null item id counts as the empty string; equal items count once; repeated documents
are each scanned; empty tables on either side give no hits.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeflow.llm.graph import stored
from citeflow.llm.words import alnum_blanked, alnum_words

WINDOW = 10
# Words of items in a block: at most about 60 MB of automaton in a task.
BLOCK_WORDS = 100_000
CHUNK_WORDS = 2_000
# A document is dropped by ``cleaned`` if more than this share of its words is hit.
MAX_COVERAGE = 0.5


class ItemAutomaton:
    """Generalised suffix automaton over the word sequences of items.

    State 0 is the root. ``step`` maps (state, word) to a state, ``link`` is the longest proper
    suffix in another state, ``length`` the longest sequence of a state.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        coded = []
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            if ids:
                coded.append((item, ids))
        self.length, self.link, self._next = [0], [-1], [{}]
        for _, ids in coded:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        self.base = len(self.vocabulary) + 1
        self._mark(coded)
        self.step = {s * self.base + w: t for s, by in enumerate(self._next) for w, t in by.items()}
        del self._next
        pairs = {a * self.base + b for _, ids in coded for a, b in zip(ids, ids[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.shortest = min((min(window, len(ids)) for _, ids in coded), default=window)

    def _new(self, length: int, moves: dict, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self._next.append(moves)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """Clone of ``target`` for the sequences up to one word longer than those of ``state``."""
        clone = self._new(self.length[state] + 1, dict(self._next[target]), self.link[target])
        self.link[target] = clone
        while state >= 0 and self._next[state].get(word) == target:
            self._next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        target = self._next[last].get(word)
        if target is not None:  # an earlier item holds this sequence
            if self.length[target] == self.length[last] + 1:
                return target
            return self._split(last, word, target)
        state, new = last, self._new(self.length[last] + 1, {}, 0)
        while state >= 0 and word not in self._next[state]:
            self._next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self._next[state][word]
            fits = self.length[target] == self.length[state] + 1
            self.link[new] = target if fits else self._split(state, word, target)
        return new

    def _state_of(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a longer match."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _mark(self, coded: list[tuple[str, list[int]]]) -> None:
        self.items_of: dict[int, set[str]] = defaultdict(set)
        self.short: dict[int, dict[int, set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, ids in coded:
            state = 0
            for n, word in enumerate(ids, 1):
                state = self._next[state][word]
                if n >= self.window:
                    self.items_of[self._state_of(state, self.window)].add(item)
            if len(ids) < self.window:
                self.short[self._state_of(state, len(ids))][len(ids)].add(item)
        self.short = {s: dict(by) for s, by in self.short.items()}
        self.items_of = dict(self.items_of)
        # The nearest state with a short item, itself included, on the way to the root.
        self.nearest = [-1] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.nearest[state] = state if state in self.short else self.nearest[self.link[state]]

    def _runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words that are neighbours in items, of the length of the shortest window."""
        if len(self.pairs):
            pairs = ids[:-1].astype(np.int64) * self.base + ids[1:]
            at = np.searchsorted(self.pairs, pairs)
            at[at == len(self.pairs)] = 0
            joined = self.pairs[at] == pairs
        else:
            joined = np.zeros(max(0, len(ids) - 1), bool)
        cuts = np.flatnonzero(~joined) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(ids)]))
        long = (ends - starts >= self.shortest) & (ids[starts] > 0)
        return zip(starts[long].tolist(), ends[long].tolist())

    def matches(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words stand in an occurrence of a window, and the items of those windows."""
        hit, found = np.zeros(len(words), bool), set()
        if not words or not self.vocabulary:
            return hit, found
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        if not ids.any():
            return hit, found
        for start, end in self._runs(ids):
            state, size = 0, 0
            for i in range(start, end):
                word = int(ids[i])
                moved = self.step.get(state * self.base + word)
                while moved is None and state:
                    state = self.link[state]
                    size = self.length[state]
                    moved = self.step.get(state * self.base + word)
                state, size = (0, 0) if moved is None else (moved, size + 1)
                if size >= self.window:
                    hit[i - self.window + 1:i + 1] = True
                    found |= self.items_of[self._state_of(state, self.window)]
                mark = self.nearest[state] if state else -1
                while mark > 0:
                    for length, items in self.short[mark].items():
                        if length <= size:
                            hit[i - length + 1:i + 1] = True
                            found |= items
                    mark = self.nearest[self.link[mark]]
        return hit, found


def _chunks(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item, words, n``: distinct pieces of at most ``CHUNK_WORDS`` words."""
    rows = benchmark.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stride = CHUNK_WORDS - WINDOW + 1
        for batch in batches:
            out = []
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = alnum_words(body)
                for at in range(0, max(1, len(words) - WINDOW + 1), stride):
                    piece = words[at:at + CHUNK_WORDS]
                    if piece:
                        out.append((item, b" ".join(piece), len(piece)))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()),
                 pa.array(columns[2], pa.int64())], ["item", "words", "n"],
            )

    return rows.mapInArrow(cut, "item STRING, words BINARY, n BIGINT").distinct()


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                block_words: int = BLOCK_WORDS) -> Iterator[ItemAutomaton]:
    """Automata of all items, each of at most twice ``block_words`` words."""
    chunks = stored(_chunks(benchmark, item_id, text), benchmark.sparkSession, "items")
    total = chunks.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    while True:  # the bound is checked, not assumed
        dealt = chunks.withColumn("block", F.expr(f"pmod(xxhash64(item, words), {blocks})"))
        largest = dealt.groupBy("block").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
        if largest <= max(2 * block_words, CHUNK_WORDS):
            break
        blocks *= 2
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).select("item", "words").collect()
        yield ItemAutomaton(sorted((r.item, bytes(r.words).split()) for r in rows))


def _spans(hit: np.ndarray) -> list[int]:
    """Starts and ends of the runs of hit words, in turn."""
    return np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))).tolist()


def _noted(automaton: ItemAutomaton, body, n_words, spans, items) -> tuple:
    """What this block finds, added to what earlier ones found."""
    words = alnum_words(body)
    hit, found = automaton.matches(words)
    for k in range(0, len(spans), 2):
        hit[spans[k]:spans[k + 1]] = True
    return len(words), _spans(hit), sorted(found.union(items))


def _marked(automaton: ItemAutomaton, body, n_words, n_hit, spans) -> tuple:
    """What this block finds in the unchanged text, added to what earlier blocks found."""
    words = alnum_words(body)
    hit, _ = automaton.matches(words)
    for k in range(0, len(spans), 2):
        hit[spans[k]:spans[k + 1]] = True
    return max(n_words, len(words)), n_hit, _spans(hit)


def _without(body: bytes, spans: list[int]) -> bytes:
    """The text without the words of spans and what stands between them."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", alnum_blanked(body))]
    pieces, at = [], 0
    for k in range(0, len(spans), 2):
        pieces.append(body[at:places[spans[k]][0]])
        at = places[spans[k + 1] - 1][1]
    return b"".join(pieces) + body[at:]


def _cut_marked(_, body, n_words, n_hit, spans) -> tuple:
    """The text without the spans of all blocks."""
    return _without(body, spans), n_words, n_hit + sum(spans[1::2]) - sum(spans[::2]), []


def _cut(automaton: ItemAutomaton, body, n_words, n_hit, spans) -> tuple:
    """The text without hit words, until no window is left; for an automaton of all items."""
    while True:
        n_words, n_hit, spans = _marked(automaton, body, n_words, n_hit, [])
        if not spans:
            return body, n_words, n_hit, spans
        body, n_words, n_hit, spans = _cut_marked(None, body, n_words, n_hit, spans)


def _ahead(values: Iterator) -> Iterator[tuple]:
    """Each value, and whether another follows."""
    held = next(values, None)
    while held is not None:
        following = next(values, None)
        yield held, following is not None
        held = following


def _begun(docs: DataFrame, text: str, added: dict) -> DataFrame:
    """``row`` (the input row), ``body`` and the columns ``added``."""
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("body"),
        *(start.alias(name) for name, start in added.items()),
    )


def _visited(state: DataFrame, automaton: ItemAutomaton | None, visit) -> DataFrame:
    """What ``visit`` makes of each row; the text stays as it is if it returns none."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in state.schema])
    shared = state.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[1:]]
            made = list(zip(*(visit(automaton, *values) for values in zip(*columns))))
            if len(made) < len(columns):  # the text stays as it is
                made = [columns[0], *made]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(
                    pa.array(m, f.type) for m, f in zip(made, list(batch.schema)[1:])
                )], names=batch.schema.names,
            )

    return state.mapInArrow(run, schema)


def _passes(state: DataFrame, blocks: Iterator[tuple], visit) -> DataFrame:
    """One pass of all rows for each block; between passes the rows are stored."""
    for automaton, more in blocks:
        state = _visited(state, automaton, visit)
        if more:
            state = stored(state, state.sparkSession, "scanned")
    return state


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``row`` (the input row), ``n_words``, ``spans`` (word starts and ends in turn) and ``items``."""
    added = {
        "n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<int>"),
        "items": F.array().cast("array<string>"),
    }
    blocks = _ahead(item_blocks(benchmark, item_id, item_text, block_words))
    return _passes(_begun(docs, text, added), blocks, _noted).drop("body")


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
           **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each row."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = scan(narrow, benchmark, "text", **options)
    # Starts and ends alternate: x - (y - (... )) is the sum of ends less the sum of starts.
    n_hit = F.expr("aggregate(spans, 0L, (s, x) -> x - s)")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _cut_all(state: DataFrame, blocks) -> DataFrame:
    """Rows without windows of any block, however items are dealt to blocks.

    Spans of all blocks are collected on the unchanged text and cut at once; changed rows pass all
    blocks again until nothing is hit. A single block does that within its tasks.
    """
    spark, done = state.sparkSession, []
    first, more = next(dealt := blocks())
    if not more:
        return _visited(state, first, _cut)
    while True:
        found = stored(_passes(state, chain([(first, True)], dealt), _marked), spark, "marked")
        done.append(found.where(F.size("spans") == 0))
        changed = found.where(F.size("spans") > 0)
        if changed.isEmpty():
            return reduce(DataFrame.union, done)
        state = _visited(changed, None, _cut_marked)
        first, _ = next(dealt := blocks())


def cleaned(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
            item_text: str = "text", max_coverage: float = MAX_COVERAGE,
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without test items; the columns are those of ``docs``.

    Spans of at least ten item words, and spans that cover a whole shorter item, are cut out.
    A document of which more than ``max_coverage`` is hit is dropped. ``n_chars``, if there is
    such a column, follows the new text. Texts without hits are returned as they were.
    """
    added = {
        "n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"), "spans": F.array().cast("array<int>"),
    }
    found = _cut_all(_begun(docs, text, added), lambda: _ahead(item_blocks(benchmark, item_id, item_text, block_words)))
    kept = found.where(F.col("n_hit") <= max_coverage * F.col("n_words"))
    new = F.when(F.col("n_hit") > 0, F.decode("body", "UTF-8")).otherwise(F.col(f"row.`{text}`"))
    out = []
    for field in docs.schema:
        value = F.col(f"row.`{field.name}`")
        if field.name == text:
            value = new
        elif field.name == "n_chars":
            value = F.when(F.col("n_hit") > 0, F.length(new).cast(field.dataType)).otherwise(value)
        out.append(value.alias(field.name))
    return kept.select(*out)
