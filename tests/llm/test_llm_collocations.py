import numpy as np
import pandas as pd

from citeflow.llm import collocations
from citeflow.llm.oracles import ORACLES
from citeflow.llm.queries import QUERIES
from tests.check import connect, differences

SF = "/root/testdata/sf0.001"


def test_query_matches_sql_on_small_table(spark):
    got = QUERIES["op11_collocations"](spark, SF).toPandas()
    assert len(got) and differences(got, connect(SF).execute(ORACLES["op11_collocations"]).df()) == ""


def test_split_units_give_the_same_counts(spark, tables):
    docs = tables("documents")
    whole = collocations.counts(docs)[0].toPandas()
    split = collocations.counts(docs, budget=3)[0].toPandas()
    assert differences(split, whole) == ""
    mined = collocations.mine(docs, budget=3).drop("k").toPandas()
    assert differences(mined, QUERIES["op11_collocations"](spark, SF).toPandas()) == ""


def test_hot_word_and_containment(spark):
    # "of the" stands in every piece; "a of the" and "of the b" share it.
    rows = [(i, "a of the b. of the c, Of The", "en") for i in range(30)] + [(99, None, None), (100, "", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.phrase: r for r in collocations.mine(docs, budget=2).collect()}
    # "of the": 90 times; held by "a of the" (30) and "of the b" (30), less than half: kept.
    assert got["of the"].a == 90 and got["of the"].n == 30 * 9
    # "a of": 30 times, inside "a of the" with 30: dropped. "a of the": cuts 30*30/(30*90) and 30*30/(30*30).
    assert "a of" not in got and got["a of the"].score == 1000000 * 30 * 30 // (30 * 90)
    assert got["a of the"].k == 1 and {r.lang for r in got.values()} == {"en"}


def test_odd_rows(spark, odd_docs, no_docs):
    # Only the long text repeats phrases: its trigrams hold every bigram at more than half.
    got = collocations.mine(odd_docs).collect()
    assert len(got) == 5 and all(r.lang == "en" and len(r.phrase.split()) == 3 and r.a >= 7999 for r in got)
    assert collocations.mine(no_docs).count() == 0
    long = spark.createDataFrame([(1, "x y z " * 4000, None)], "doc_id long, text string, lang string")
    got = {r.phrase: r for r in collocations.mine(long).collect()}
    # Every bigram lies in a trigram of (nearly) the same count, so only trigrams stay.
    assert got["x y z"].a == 4000 and got["x y z"].lang == "und" and "x y" not in got
    assert got["x y z"].n == 12000


def test_rare_phrases_are_cut_off_before_they_are_stored(spark):
    """Leaves end before rare phrases; totals, frequent phrases and what is mined stay the same."""
    rows = [(i, f"of the w{i} w{i} v{i}, ones{i} of the by.by", "en" if i % 3 else None) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = {(r.lang, r.leaf): r.c for r in collocations.leaves(docs).collect()}
    cut = {(r.lang, r.leaf): r.c for r in collocations.leaves(docs, min_count=10).collect()}
    assert len(cut) < len(whole) / 10 and sum(cut.values()) == sum(whole.values()) == 10 * 400
    every = {(r.lang, r.phrase): r.f for r in collocations.counts(docs)[0].collect()}
    found = {(r.lang, r.phrase): r.f for r in collocations.counts(docs, min_count=10)[0].collect()}
    often = {k: f for k, f in every.items() if f >= 10}
    assert {k: f for k, f in found.items() if f >= 10} == often and ("und", "of the by") in often


def test_a_full_group_is_small_in_memory():
    n = collocations.BUDGET
    words = np.array([f"word{i}" for i in range(30_000)], object)
    a, b, c = (words[np.random.default_rng(k).integers(0, len(words), n)] for k in range(3))
    group = pd.DataFrame({"lang": "en", "grp": 0, "c": 1, "level": 1, "size": 3, "p1": a, "p2": a + " " + b,
                          "p3": a + " " + b + " " + c})
    assert group.memory_usage(deep=True).sum() < 1 << 27
    nodes = collocations._node_counts(group)
    assert nodes.groupby("n_words")["f"].sum().tolist() == [n] * 3
