"""Work that must not grow: what a rendering shuffles, which files a phase opens, what is marked
for the parser and what a path expression reads."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from citeflow.functions.text import MARK, first_text, mark
from citeflow.operators import documents as docs
from citeflow.operators.tables import changes
from citeflow.plans import corpora
from citeflow.plans.queries import QUERIES, _cut_first
from citeflow.plans.store import CitationStore
from citeflow.sources.records import read_checked

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("render", [corpora.articles, corpora.books, corpora.revisions, corpora.kinds])
def test_rows_travel_to_their_files_unrendered(spark, render):
    placed = render(spark, SF)
    assert "xml" not in placed.rows.columns
    source = placed.rows.drop("folder", "file").count()
    files = spark.read.text(corpora.corpus_dir(spark, SF, render))
    assert files.where(F.col("value").rlike("^<(Pubmed|Delete|Book|Retr)")).count() >= source


def _leaves(plan) -> list:
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _leaves(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return _leaves(plan.plan())
    children = plan.children()
    found = [leaf for i in range(children.size()) for leaf in _leaves(children.apply(i))]
    return found or [plan]


def _files_opened(rows) -> int:
    rows.collect()
    leaves = _leaves(rows._jdf.queryExecution().executedPlan())
    scans = [s for s in leaves if s.getClass().getSimpleName() == "FileSourceScanExec"]
    return sum(s.metrics().apply("numFiles").value() for s in scans)


def test_a_phase_opens_its_own_files_only(spark):
    whole = corpora.corpus(spark, SF, corpora.revisions)
    parts = [corpora.corpus(spark, SF, corpora.revisions, phase=p) for p in (0, 1)]
    total = _files_opened(whole.select("file", "kind", "raw_xml"))
    each = [_files_opened(p.select("file", "kind", "raw_xml")) for p in parts]
    assert min(each) > 0 and sum(each) == total
    both = parts[0].unionByName(parts[1]).select("phase", "file", "raw_xml")
    assert both.exceptAll(whole.select("phase", "file", "raw_xml")).count() == 0
    assert both.count() == whole.count()


def test_insert_if_absent_reads_each_file_once(spark):
    total = _files_opened(corpora.corpus(spark, SF, corpora.revisions).select("raw_xml"))
    assert _files_opened(QUERIES["insert_if_absent"](spark, SF)) == total


def test_marker_stays_out_of_containers(spark):
    raw = (
        "<Article>\n<AuthorList> <Author> <LastName> x</LastName></Author></AuthorList>\n"
        "<ArticleTitle><i>a</i> <b>c</b></ArticleTitle></Article>"
    )
    marked = spark.range(1).select(mark(F.lit(raw))).first()[0]
    assert marked.replace(MARK, "|") == (
        "<Article>\n<AuthorList> <Author> <LastName>| x</LastName></Author></AuthorList>\n"
        "<ArticleTitle>|<i>a</i>| <b>c</b></ArticleTitle></Article>"
    )


def test_cut_halves_the_file_once(spark, tmp_path):
    part = tmp_path / "folder=baseline" / "file=a" / "part-0.txt.gz"
    part.parent.mkdir(parents=True)
    part.write_bytes(bytes(1000))
    _cut_first(spark, str(tmp_path), "baseline")
    assert part.stat().st_size == 500


def test_a_file_is_named_once_per_chunk(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<PubmedArticle></PubmedArticle>")
    records, _ = read_checked(spark, [str(tmp_path)], lambda path: F.concat(F.lit("NAMED"), path))
    plan = changes(records)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("NAMED") == 1


def test_file_of_whole_records_alone_is_not_damaged(spark, tmp_path):
    """No chunk but whole records: the observation names nothing, the changes name the file."""
    record = (
        '<PubmedArticle><MedlineCitation><PMID Version="1">1</PMID><Article><ArticleTitle>t</ArticleTitle>'
        "</Article></MedlineCitation></PubmedArticle>"
    )
    (tmp_path / "data").mkdir()
    for name, text in (("a", record), ("b", ""), ("c", record + "\n")):
        (tmp_path / "data" / f"{name}.xml.gz").write_bytes(gzip.compress(text.encode()))
    store = CitationStore.create(spark, str(tmp_path / "store"), buckets=2)
    store.load(str(tmp_path / "data"))
    assert [r.file for r in store.bad_files().collect()] == ["b.xml.gz"]
    assert {r.fn for r in store.ledger().collect()} == {"a.xml.gz", "c.xml.gz"}


def test_first_text_searches_only_behind_a_child(spark):
    rows = spark.createDataFrame(
        [([MARK, "x"],), (["a" + MARK, "b"],), ([MARK],), ([],), (None,)], "nodes ARRAY<STRING>")
    assert [r[0] for r in rows.select(first_text(F.col("nodes"))).collect()] == ["x", "a", None, None, None]
