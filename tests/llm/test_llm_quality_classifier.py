import zlib

import numpy as np

from citeflow.llm import quality_classifier as qc
from citeflow.llm.queries import QUERIES


def test_neighbours_against_plain_loops():
    rng = np.random.default_rng(0)
    index = qc.index_vectors()
    rows = rng.integers(0, 30, 500)
    rows[100:102] = qc.ROWS
    got = np.zeros((qc.ROWS + 1, qc.DIM), np.int64)
    qc.add_neighbours(got, index, rows)
    want = np.zeros_like(got)
    for i in range(len(rows)):
        for j in range(max(0, i - qc.REACH), min(len(rows), i + qc.REACH + 1)):
            if i != j:
                want[rows[i]] += index[rows[j]]
    assert (got == want).all()


def test_long_texts_are_cut_without_loss(monkeypatch):
    index, rows = qc.index_vectors(), np.random.default_rng(1).integers(0, 40, 700)
    whole, cut = np.zeros((qc.ROWS + 1, qc.DIM), np.int64), np.zeros((qc.ROWS + 1, qc.DIM), np.int64)
    qc.add_neighbours(whole, index, rows)
    monkeypatch.setattr(qc, "CHUNK_TOKENS", 64)
    qc.add_neighbours(cut, index, rows)
    assert (whole == cut).all()


def test_held_out_accuracy(spark, tables):
    labels = {r.doc_id: r.quality for r in tables("labels", "sf0.1").collect()}
    got = QUERIES["op8_quality_classifier"](spark, "/root/testdata/sf0.1").collect()
    assert len(got) == tables("documents", "sf0.1").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    judged = [(r, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert len(judged) > 500
    right = {q: np.mean([r.predicted == q for r, t in judged if t == q]) for q in (0, 1)}
    assert right[1] > 0.98 and right[0] > 0.9
    calibration = abs(np.mean([r.score for r, _ in judged]) - np.mean([t for _, t in judged]))
    assert calibration < 0.03


def test_odd_rows(spark, odd_docs, no_docs, tables):
    labels = spark.createDataFrame([(4, 1, 0), (4, None, 0), (999, 0, 0), (None, 1, 1)], "doc_id BIGINT, quality INT, toxic INT")
    got = qc.score(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert qc.score(no_docs, labels).count() == 0
    assert qc.score(odd_docs, labels.where("false")).where("score <> 0.5").count() == 0


def test_training_of_two_classes():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, qc.DIM + 3)).astype(np.float32)
    y = (np.abs(x[:, 0]) + 0.1 * rng.normal(size=4000) > 0.7).astype(float)  # no line parts these
    network = qc.train(x, y)
    assert np.mean((network.probabilities(x) > 0.5) == y) > 0.8
    assert (qc.train(x, y).probabilities(x) == network.probabilities(x)).all()
