import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from citeflow.llm import ngram_lm as lm
from citeflow.llm.elias_fano import EliasFano
from citeflow.llm.queries import QUERIES


@pytest.mark.parametrize("top", [1, 7, 1000, 10**6, 2**62])
def test_elias_fano_access_and_successor(top):
    rng = np.random.default_rng(top % 97)
    for n in (1, 2, 63, 64, 65, 500, 3000):
        values = np.sort(rng.integers(0, top, n, endpoint=True))
        if n > 100 and top > 10**5:
            values[n // 2:n // 2 + 90] = values[n // 2]  # long runs of equal values
            values = np.sort(values)
        ef = EliasFano.of(EliasFano.encode(values).arrays("x"), "x")
        assert (ef.access(np.arange(n)).astype(np.int64) == values).all()
        asked = np.concatenate([values, values + 1, np.maximum(values - 1, 0), [0, top, top + 1]])
        assert (ef.successor(asked) == np.searchsorted(values, asked)).all()
        first = rng.integers(0, n, len(asked))
        last = np.minimum(n, first + rng.integers(0, 50, len(asked)))
        want = [f + int(np.searchsorted(values[f:e], a)) for a, f, e in zip(asked, first, last)]
        assert ef.successor(asked, first, last).tolist() == want


def words_of(text):
    return [*(text or "").encode().lower().split(), b""]


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


class Brute:
    """The same model in dictionaries, without quantisation."""

    def __init__(self, texts, min_count=1):
        self.min_count = min_count
        self.counts = [Counter() for _ in range(3)]
        for t in texts:
            w = words_of(t)
            for k in range(3):
                self.counts[k].update(tuple(w[i:i + k + 1]) for i in range(len(w) - k))
        self.n, self.v = sum(self.counts[0].values()), len(self.counts[0])
        self.left = defaultdict(lambda: 1.0)
        for k in (1, 2):
            for gram, c in self.counts[k].items():
                if c >= min_count:
                    self.left[gram[:-1]] -= (c - lm.DISCOUNT) / self.counts[k - 1][gram[:-1]]

    def p(self, context, word):
        if not context:
            return (self.counts[0][(word,)] + 1) / (self.n + self.v + 1)
        c = self.counts[len(context)][(*context, word)]
        own = (c - lm.DISCOUNT) / self.counts[len(context) - 1][context] if c >= self.min_count else 0
        return own + self.left[context] * self.p(context[1:], word)

    def score(self, text):
        w = words_of(text)
        logs = [math.log10(self.p(tuple(w[max(0, i - 2):i]), x)) for i, x in enumerate(w)]
        base = [math.log10(self.p((), x)) for x in w]
        return len(w), sum(self.counts[0][(x,)] > 0 for x in w), self.n, sum(base), sum(logs)


def compare(got, rows, min_count=1):
    brute = Brute([t for k, t in rows if not held(k)], min_count)
    want = sorted(((k, held(k), *brute.score(t)) for k, t in rows), key=repr)
    got = sorted(map(tuple, got), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5]))
        assert abs(g[6] - w[6]) <= 0.0012 * w[2] + 1e-9, (g, w)
    return got


def test_query_agrees_with_brute_force(spark, tables):
    rows = [(r.doc_id, r.text) for r in tables("documents", "sf0.01").collect()]
    got = compare(QUERIES["op10_ngram_scores"](spark, "/root/testdata/sf0.01").collect(), rows)
    unseen = [g for g in got if g[1]]
    assert sum(g[6] for g in unseen) > sum(g[5] for g in unseen)  # the model beats its base on them


def test_small_chunks_and_many_shards(spark, tables, monkeypatch):
    monkeypatch.setattr(lm, "COUNTER_WORDS", 50)
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 300)
    rows = [(r.doc_id, r.text) for r in tables("documents").limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compare(lm.score(docs, weight_bits=4).collect(), rows, lm.MIN_COUNT)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_clashing_hashes_take_another_seed(spark):
    rows = [(1, "a b c d e a b"), (2, "b c a b"), (5, "x")]
    texts = spark.createDataFrame(rows, "doc_id BIGINT, body STRING").selectExpr(
        "true AS learned", "CAST(body AS BINARY) AS body")
    distinct = sorted({w for _, t in rows for w in words_of(t)})
    good = next(s for s in range(1, 500) if len(set(lm.hashes(distinct, s, 4))) == len(distinct))
    trie, coded = lm.build(texts, 2, hash_bits=4)
    assert coded.columns == ["learned", "ids"]
    assert trie.seed == good > 1 and sorted(trie.word_ids(distinct)) == list(range(len(distinct)))


def test_odd_rows(spark, odd_docs, no_docs):
    compare(lm.score(odd_docs).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert lm.score(no_docs).count() == 0
    unlearned = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id BIGINT, text STRING")
    assert sorted(r.n_tokens for r in lm.score(unlearned).collect()) == [1, 3]


class Whole(Brute):
    """The model of all n-grams, those seen once included."""

    def __init__(self, texts):
        super().__init__(texts)
        self.left = defaultdict(lambda: 1.0)
        for k in (1, 2):
            for gram, c in self.counts[k].items():
                self.left[gram[:-1]] -= (c - lm.DISCOUNT) / self.counts[k - 1][gram[:-1]]

    def p(self, context, word):
        if not context:
            return super().p(context, word)
        c = self.counts[len(context)][(*context, word)]
        own = (c - lm.DISCOUNT) / self.counts[len(context) - 1][context] if c else 0
        return own + self.left[context] * self.p(context[1:], word)


def test_query_keeps_ngrams_seen_once(spark, tables, monkeypatch):
    monkeypatch.setitem(globals(), "Brute", Whole)
    rows = [(r.doc_id, r.text) for r in tables("documents").collect()]
    compare(QUERIES["op10_ngram_scores"](spark, "/root/testdata/sf0.001").collect(), rows)


def test_shards_are_bounded_and_hot_contexts_span_some(spark):
    rows = [(i, f"the a{i} the b{i % 50} the c{i}" + " the the" * (i % 3)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    compare(lm.score(docs, weight_bits=7, min_count=1).collect(), rows)
    texts = docs.selectExpr("true AS learned", "CAST(text AS BINARY) AS body")
    trie, _ = lm.build(texts, min_count=1, weight_bits=7)
    assert all(s.n <= 2 << 7 for level in trie.levels[1:] for s in level)
    the = trie.word_ids([b"the"])[0]
    assert sum(s.first_parent == the for s in trie.levels[1]) > 2


def test_packed_blocks_take_few_bytes():
    rng = np.random.default_rng(5)
    grams = lm._counted_pairs(rng.integers(7, 40_000, 100_000), rng.integers(0, 2**17, 100_000))
    body = lm._packed(*grams, 5)
    assert all((a == b).all() for a, b in zip(lm._unpacked(body, 5), grams)) and len(body) < 4 * len(grams[0])
