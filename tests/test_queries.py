"""Every registered query against its oracle, and the plans of the important ones."""

import pytest

import __spark_entry__ as entry
from citeflow.operators import tables as tab
from citeflow.operators.documents import documents
from citeflow.plans import corpora
from citeflow.plans.corpora import corpus
from citeflow.plans.oracles import ORACLES
from citeflow.plans.queries import QUERIES
from tests.check import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    assert got.columns and differences(got.toPandas(), duck.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_records_are_parsed_once(spark):
    records = corpus(spark, SF, corpora.articles)
    assert plan_of(documents(records)).count("from_xml") == 1
    assert plan_of(tab.apply_deletes(tab.changes(records))).count("from_xml") == 1
    assert plan_of(documents(records).where("title = ''")).count("from_xml") == 1


def test_upsert_cuts_rows_before_the_shuffle(spark):
    plan = plan_of(tab.apply_deletes(tab.changes(corpus(spark, SF, corpora.revisions))))
    before, after = plan.split("Exchange", 1)
    assert plan.count("Exchange") == 1
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_narrow_jobs_ask_the_parser_for_little(spark):
    plan = plan_of(documents(corpus(spark, SF, corpora.articles), ("title",)))
    assert "ArticleTitle" in plan and "AuthorList" not in plan and "ReferenceList" not in plan
