"""Every query of the subpackage over sf0.01, the mix, and the pipeline."""

import inspect
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from citeflow.llm import mixture, quality_rules
from citeflow.llm.oracles import ORACLES
from citeflow.llm.queries import QUERIES
from tests.check import connect, differences
from tests.llm.test_llm_decontaminate import brute as brute_hits
from tests.llm.test_llm_simhash import brute_groups

SF = "/root/testdata/sf0.01"


def test_all_are_registered():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert differences(got, connect(SF).execute(ORACLES[name]).df()) == ""


def test_native_plans(spark, odd_docs):
    for rows in (quality_rules.apply_rules(odd_docs), mixture.mix(odd_docs)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|BroadcastNestedLoop", plan)


def test_odd_rows_of_rules(odd_docs, no_docs):
    got = quality_rules.apply_rules(odd_docs, keep=["doc_id", "fp"]).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == odd_docs.count() and by[1].n_words == by[2].n_words == by[3].n_words == 0
    assert not by[1].kept and by[4].kept and by[6].n_words == 40_000 and by[6].n_repeat_words == 40_000
    assert quality_rules.keep_good(odd_docs).columns == odd_docs.columns
    assert sorted(r.doc_id for r in quality_rules.keep_good(odd_docs).collect()) == [4, 4, 5]
    assert quality_rules.keep_good(no_docs).count() == 0


def test_filters_stay_above_the_measures(odd_docs):
    plan = quality_rules.keep_good(odd_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("inline") and plan.count("xxhash64") == 1


def test_repeated_windows_by_hand(spark):
    text = "a b c d e x a b c d e y z"
    row = quality_rules.signals(spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")).first()
    assert row.n_repeat_words == 10 and row.n_words == 13


def test_odd_rows_of_mix(odd_docs, no_docs):
    got = mixture.mix(odd_docs).collect()
    assert len(got) == odd_docs.count() and {r.size for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert mixture.mix(no_docs).count() == 0
    rows = mixture.mixed_rows(odd_docs)
    assert rows.columns == odd_docs.columns and rows.count() == sum(r.copies for r in got)


def test_mix_comes_near_its_targets(spark, tables):
    docs = tables("documents", "sf0.01")
    runs = [sorted(map(tuple, mixture.mix(d).select("doc_id", "size", "source", "target", "taken").collect()))
            for d in (docs, docs.repartition(5))]
    assert runs[0] == runs[1]
    longest = {}
    for _, size, source, target, taken in runs[0]:
        top, total, _ = longest.get(source, (0, 0, 0))
        longest[source] = (max(top, size), total + taken, target)
    for top, total, target in longest.values():
        assert abs(total - target) <= top
    assert abs(sum(t for _, _, t in longest.values()) - sum(r[1] for r in runs[0])) < 1e-3


def test_many_sources_and_caps(spark):
    rng = np.random.default_rng(4)
    sizes = [int(s) for s in np.exp(rng.uniform(0, 7, 60))]
    rows = [(k, "w " * n, None if k == 7 else f"s{k % 40:02d}") for k, n in enumerate(sizes)]
    got = mixture.mix(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")).collect()
    per = {}
    for r in got:
        per.setdefault(r.source, [r.source_size, r.target, 0])[2] += r.taken
    order = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped = sum(p[0] for p in per.values()), set()
    while True:
        level = (total - sum(3 * per[s][0] for s in capped)) / sum(weight[s] for s in per if s not in capped)
        over = {s for s in per if s not in capped and weight[s] * level > 3 * per[s][0]}
        if not over:
            break
        capped |= over
    for s, (size, target, _) in per.items():
        assert target == pytest.approx(3 * size if s in capped else weight[s] * level)


def brute_pipeline(spark, sf_dir):
    """What the stages keep, stage by stage, from plain Python and SQL."""
    con = connect(sf_dir)
    rules = con.execute(ORACLES["op4_quality_rules"]).df()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    kept = [docs[k] for k in rules.doc_id[rules.kept]]
    groups = brute_groups([(r.doc_id, r.text) for r in kept])
    alone = [docs[k] for k, _, g in groups if k == g]
    return kept, alone


def test_pipeline_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, stages = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, sf_dir).toPandas()
        stages.append(rows)
        if len(stages) < len(corpus_pipeline.STAGES):
            assert list(rows.columns) == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = spark.createDataFrame(rows, docs.schema)
    kept, alone = brute_pipeline(spark, sf_dir)
    assert sorted(stages[0].doc_id) == sorted(r.doc_id for r in kept)
    assert sorted(stages[1].doc_id) == sorted(r.doc_id for r in alone)
    items = [(str(r.item_id), words(r.text)) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {r.doc_id: r.text for r in stages[2].itertuples()}
    changed = 0
    for r in alone:
        hit, _ = brute_hits(words(r.text), items)
        if not hit:
            assert clean[r.doc_id] == r.text
        else:
            changed += 1
            assert r.doc_id not in clean or not brute_hits(words(clean[r.doc_id]), items)[0]
    assert changed
    sizes = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for k, t in clean.items()}
    counts = stages[3].doc_id.value_counts().to_dict()
    want = {r.doc_id: r.copies for r in mixture.mix(spark.createDataFrame(stages[2], docs.schema)).collect()}
    assert counts == {k: c for k, c in want.items() if c} and all(c <= 3 for c in counts.values())
    assert sum(sizes[k] * c for k, c in counts.items()) == pytest.approx(sum(sizes.values()), rel=0.2)
    check_tokens(stages[3], stages[4])
    run = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert differences(run, stages[4]) == ""


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def check_tokens(docs, rows):
    from tokenizers import Tokenizer

    from citeflow.llm.queries import TOKENIZER

    tokenizer, at, want = Tokenizer.from_file(TOKENIZER), 0, []
    for r in docs.sort_values("doc_id").itertuples():
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(rows[["doc_id", "start", "n_tokens", "ids_crc32"]].itertuples(index=False, name=None)) == want


def test_stages_take_three_arguments():
    assert all(len(inspect.signature(f).parameters) == 3 for _, f in corpus_pipeline.STAGES)
