import random

import corpus_pipeline
from citeflow.llm import near_jaccard as near


def shingles(text):
    words = (text or "").lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def similar(x, y):
    return x == y or 5 * len(x & y) >= 4 * len(x | y)


def brute(rows):
    """Smallest id of each group, by comparing all with all."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                root[find(i)] = find(j)
    best = {}
    for i, (k, _) in enumerate(rows):
        best[find(i)] = min(best.get(find(i), k), k)
    return sorted(best.values())


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.random()}"
    return " ".join(words)


def test_stage_links_all_of_eight_tenths(spark):
    rng = random.Random(4)
    rows = []
    for group in range(30):
        base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        rows += [(group * 100 + k, edited(rng, base, k)) for k in range(7)]  # chains, and some apart
    passage = [f"p{k}" for k in range(60)]
    rows += [(9000 + k, " ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(k)])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert got == brute(rows)
    assert 31 <= len(got) < len(rows) / 2


def test_bands_meet():
    rng = random.Random(1)
    missed = 0
    for _ in range(400):
        ids = [rng.getrandbits(64) for _ in range(110)]
        one, two = (near.np.unique(near.np.array(x, near.np.uint64)) for x in (ids[:99], ids[:88] + ids[99:]))
        missed += not (near.bands(one) == near.bands(two)).any()
    assert missed <= 2  # similarity 0.8


def test_odd_rows(odd_docs, no_docs):
    kept = near.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 4, 6, 7]
    assert near.keep_one(no_docs).count() == 0


def test_whole_table_against_brute_force(spark, tables):
    docs = tables("documents")
    got = sorted(r.doc_id for r in near.keep_one(docs).collect())
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
