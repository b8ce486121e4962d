import hashlib
import random
from collections import Counter

import numpy as np

from citeflow.llm import repeats
from citeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, length=200):
    """Every window of every text counted; bytes under windows counted twice or more go."""
    bodies = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(b[i:i + length] for _, b in bodies for i in range(len(b) - length + 1))
    out = []
    for k, b in bodies:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int(np.sum(gone[1:] & ~gone[:-1]) + (gone[0] if len(b) else 0))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((k, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_query_agrees_with_brute_force(spark, tables):
    rows = [(r.doc_id, r.text) for r in tables("documents").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_repeat_removal"](spark, SF).collect()), key=repr)
    want = brute(rows)
    assert got == want
    assert sum(r[2] for r in want) > 0


def test_planted_strings_and_odd_rows(spark, odd_docs, no_docs):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = noise(230)
    rows = [
        (1, noise(300) + shared + noise(50)),
        (2, noise(40) + shared),
        (3, noise(199) + noise(199)),
        (4, (noise(150) + "x") * 3),  # repeats inside one text
        (5, noise(199)),
        (6, None), (7, ""), (None, noise(500)),
        (8, "é" * 300),  # runs of one two-byte character
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in repeats.dedup(docs).drop("kept").collect()), key=repr)
    assert got == brute(rows)
    assert {r[0]: r[2] for r in got}[1] == 230
    odd = sorted((tuple(r) for r in repeats.dedup(odd_docs).drop("kept").collect()), key=repr)
    assert odd == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert repeats.dedup(no_docs).count() == 0


def test_anchors_fall_in_every_window():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 4, 5000, dtype=np.uint8).tobytes()
    at, _ = repeats.anchors(data)
    for s in range(0, len(data) - 200 + 1):
        assert np.any((at >= s) & (at <= s + 200 - repeats.K))


def test_edges_of_repeats_in_long_and_periodic_texts(spark):
    rng = random.Random(7)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = noise(3000)
    edited = "".join("#" if i % 450 == 0 else c for i, c in enumerate(shared))
    rows = [
        (1, noise(64_000) + shared + noise(300)),  # across the place where a long text is cut
        (2, noise(70) + edited + noise(10)),
        (3, shared[700:950] + noise(400) + shared[100:299] + "!"),
        (4, noise(30) + shared[500:1100] + noise(5) + edited[800:2100]),
        *((10 + i, noise(i) + shared[1500 - i:1710 + 3 * i] + noise(9)) for i in range(30)),  # one anchor, many contexts
        (50, "ab" * 40_000), (51, noise(100) + "ab" * 120 + noise(100)), (52, "-" * 700 + noise(250) + "-" * 201),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in repeats.dedup(docs).drop("kept").collect()), key=repr)
    assert got == brute(rows)


def test_rows_kept_follow_pieces_not_bytes(spark, monkeypatch):
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = noise(30_000)
    rows = [(i, noise(500) + shared[100 * i:] + noise(500)) for i in range(12)]
    kept, write = [], repeats.stored

    def stored(frame, *args):
        out = write(frame, *args)
        kept.append(out.count())
        return out

    monkeypatch.setattr(repeats, "stored", stored)
    got = repeats.dedup(spark.createDataFrame(rows, "doc_id long, text string")).drop("kept").collect()
    assert sum(r.n_removed for r in got) > 300_000
    assert sum(kept) < sum(len(t) for _, t in rows) // 20
