import hashlib
import math
import re
import zlib

import pytest

from citeflow.llm import resample
from citeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(docs, items):
    """The contract's rows by plain Python: counts, gains, scores, then a full sort."""

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    def counts(texts):
        c = [0] * 10000
        for t in texts:
            for w in words(t):
                c[zlib.crc32(w.encode()) % 10000] += 1
        return c, sum(c)

    s, big_s = counts(t for _, t in docs)
    t, big_t = counts(items)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for i, (k, text) in enumerate(docs):
        ws = words(text)
        weight = sum(gain[zlib.crc32(w.encode()) % 10000] for w in ws)
        score = None
        if k is not None:
            h = int(hashlib.sha256(f"2024:{k}".encode()).hexdigest()[:8], 16)
            score = int(weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
        rows.append([k, len(ws), weight, score, None, i])
    eligible = sorted((r for r in rows if r[1] >= 20 and r[3] is not None), key=lambda r: (-r[3], r[0], r[5]))
    for rank, r in enumerate(eligible[: len(eligible) * 10 // 100], 1):
        r[4] = rank
    return rows


def test_query_agrees_with_brute_force(spark, tables):
    docs = [(r.doc_id, r.text) for r in tables("documents").collect()]
    items = [r.text for r in tables("benchmark").collect()]
    want = sorted((k, n, w, s, rk) for k, n, w, s, rk, _ in brute(docs, items))
    got = sorted(tuple(r) for r in QUERIES["op13_importance_resample"](spark, SF).collect())
    assert got == want
    assert sum(1 for r in got if r[4]) == sum(1 for r in want if r[1] >= 20) * 10 // 100


def test_selection_is_exact_on_ties_and_many_rounds(spark):
    # Equal scores everywhere: the order is decided by id and then by the stored row number.
    rows = [(i % 37, float(i % 5), i) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, score double, row long").repartition(7)
    ordered = sorted(rows, key=lambda r: (-r[1], r[0], r[2]))
    for k in (1, 2, 299, 1500, 3000):
        doc_id, score, row = ordered[k - 1]
        assert resample.cutoff(frame, k) == (score, doc_id, row)
    assert resample.cutoff(frame, 0) is None


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven"), (2, None)],
                                  "item_id long, text string")
    got = resample.resample(odd_docs, items).collect()
    assert len(got) == odd_docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[1][0].n_features == 0 and by_id[1][0].weight == 0 and by_id[1][0].rank is None
    assert by_id[None][0].score is None and by_id[None][0].rank is None
    assert len(by_id[4]) == 2 and by_id[4][0].score == by_id[4][1].score
    assert by_id[6][0].n_features == 40000
    # Two rows have 20 words or more (the long text and nothing else), so none is drawn.
    assert all(r.rank is None for r in got)
    assert resample.resample(no_docs, items).count() == 0


def test_repeated_rows_are_drawn_one_by_one(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(7, text)] * 25 + [(8, text)] * 5, "doc_id long, text string")
    got = resample.resample(docs, docs).collect()
    ranks = sorted(r.rank for r in got if r.rank is not None)
    assert ranks == [1, 2, 3]
    assert {r.doc_id for r in got if r.rank is not None} == {7} or len({r.score for r in got}) == 2
