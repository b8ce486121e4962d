import random

import xxhash

from citeflow.llm import simhash
from citeflow.llm.graph import components
from citeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = []
    for part in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split("\n"):
        for w in part.replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" "):
            if w:
                words.append(w)
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    """``(id, fingerprint, smallest id)`` of each row, by comparing all with all."""
    prints = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                root[find(i)] = find(j)
    best = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            best[find(i)] = min(best.get(find(i), k), k)
    return sorted(((k, f"{prints[i]:016x}", best.get(find(i))) for i, (k, _) in enumerate(rows)), key=repr)


def test_query_agrees_with_brute_force(spark, tables):
    want = brute_groups([(r.doc_id, r.text) for r in tables("documents").collect()])
    got = [tuple(r) for r in QUERIES["op9_simhash_groups"](spark, SF).collect()]
    assert sorted(got, key=repr) == want
    assert len({g[2] for g in got}) < len(got)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = [tuple(r) for r in simhash.near_duplicates(odd_docs).collect()]
    assert sorted(got, key=repr) == brute_groups(rows)
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 4, 6, 7]


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


def test_links_find_every_pair(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    prints = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for s in seeds for _ in range(20)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    got = [tuple(r) for r in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp BIGINT")).collect()]
    assert len(want) > 200 and len(got) == len(want) and set(got) == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 40)] + [(60, 50), (50, 55)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 7 for k in range(7, 40)}, 50: 50, 55: 50, 60: 50}
