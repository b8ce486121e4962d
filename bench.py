"""Headline timings: ``BENCH_SF_DIR`` (table folder), ``BENCH_CPUS`` (local cores).

Record files are rendered first and not timed: they stand for the files a load would find.
Every timed query is run to the end and its whole result consumed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.operators import tables as tab
from citeflow.operators.documents import documents
from citeflow.plans import corpora
from citeflow.plans.corpora import corpus, corpus_dir, folder_name
from citeflow.plans.queries import QUERIES
from citeflow.plans.store import CitationStore
from citeflow.plans.workspace import new_dir
from citeflow.sources.records import kind_counts

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

QUERY_NAMES = (
    "scan_records", "doc_title", "doc_abstract", "doc_pub_date", "doc_mesh", "doc_full",
    "book_docs", "upsert_latest", "apply_deletes", "insert_if_absent", "lookup_docs",
    "file_rates", "bad_records", "write_doc_json", "load_updates", "stream_load",
)


def consume(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def load(store: CitationStore, data_dir: str, store_raw: bool) -> None:
    """List files, scan, parse, write changes and ledger, then read the current view."""
    store.load(data_dir, store_raw=store_raw, name=folder_name)
    consume(store.documents())


def new_store(spark: SparkSession) -> CitationStore:
    return CitationStore.create(spark, new_dir(spark, "bench"))


def timed(run, *args) -> float:
    start = time.perf_counter()
    run(*args)
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("citeflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    renderers = (corpora.texts, corpora.articles, corpora.books, corpora.revisions, corpora.kinds)
    rendered = {r.__name__: timed(corpus_dir, spark, SF_DIR, r) for r in renderers}

    seconds, rates = {}, {}
    for render in (corpora.articles, corpora.texts):
        records = corpus(spark, SF_DIR, render)
        consume(records)  # first run of a session also compiles
        data_dir = corpus_dir(spark, SF_DIR, render)
        docs = records.where(F.col("kind") == "PubmedArticle").count()
        steps = {
            "scan": (consume, kind_counts(records)),
            "scan_document": (consume, documents(records)),
            "scan_document_upsert": (consume, tab.apply_deletes(tab.changes(records))),
            "load_raw_off": (load, new_store(spark), data_dir, False),
            "load_raw_on": (load, new_store(spark), data_dir, True),
        }
        for step, (run, *args) in steps.items():
            name = f"{step}_{render.__name__}"
            seconds[name] = timed(run, *args)
            rates[name] = round(docs / seconds[name])

    for name in QUERY_NAMES:
        seconds[name] = timed(lambda: consume(QUERIES[name](spark, SF_DIR)))

    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "docs_per_sec": rates,
        "render_sec": rendered,
        "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
