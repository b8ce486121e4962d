"""One runnable query per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow.functions.dates import medline_year as year_of_text
from citeflow.functions.text import node_text as text_of_node
from citeflow.operators import ledger as led
from citeflow.operators import quality, stats
from citeflow.operators import tables as tab
from citeflow.operators.documents import documents, parse_records, search_rows
from citeflow.plans import corpora
from citeflow.plans.corpora import corpus, corpus_dir, folder_name, table
from citeflow.plans.store import CitationStore
from citeflow.plans.workspace import new_dir
from citeflow.schema import BOOK, DOC_FIELDS
from citeflow.sources import exports
from citeflow.sources import records as rec
from citeflow.streaming.load import stream_load as start_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

WORKERS = 10


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _joined(texts: Column) -> Column:
    return F.array_join(texts, "|", "<null>")


def _terms(terms: Column) -> Column:
    return _joined(F.transform(
        terms, lambda t: F.concat(t["id"], F.lit("="), F.coalesce(t["name"], F.lit("<null>")))
    ))


def _docs(spark: SparkSession, sf_dir: str, render, fields: Sequence[str]) -> DataFrame:
    return documents(corpus(spark, sf_dir, render), fields)


def _flat(docs: DataFrame) -> DataFrame:
    """Lists as joined strings."""
    return docs.withColumns({
        "authors": _joined(F.col("authors")),
        "article_types": _joined(F.col("article_types")),
        "compounds": _terms(F.col("compounds")),
        "mesh": _terms(F.col("mesh")),
    })


# Scans and sources --------------------------------------------------------------------------


def _revisions(spark: SparkSession, sf_dir: str, phase: int | None = None) -> DataFrame:
    """All records, or those of one phase, whose folder alone is then read."""
    return corpus(spark, sf_dir, corpora.revisions, phase=phase)


@query
def scan_records(spark, sf_dir):
    """Every record with its kind, first id and place in its file."""
    place = F.row_number().over(Window.partitionBy("file").orderBy("block", "ord"))
    first_id = F.get(rec.block_ids(F.col("raw_xml")), F.lit(0))
    return _revisions(spark, sf_dir).select(
        "file", "phase", "kind", place.alias("place"), first_id.alias("first_id")
    )


@query
def raw_split_pmid(spark, sf_dir):
    return rec.raw_split(corpus(spark, sf_dir, corpora.texts)).select("file", "pmid")


def _change_stats(spark: SparkSession, sf_dir: str, phase: int | None = None) -> DataFrame:
    """Counts per file as scanned; quantities stand in for seconds."""
    counts = stats.file_counts(_revisions(spark, sf_dir, phase))
    lines = corpora.place_changes(table(spark, sf_dir, "lineitem"))
    name = F.concat("folder", F.lit("/"), "file", F.lit(".xml.gz"))
    seconds = lines.groupBy(name.alias("file")).agg(F.sum("l_quantity").alias("duration"))
    return counts.join(seconds, "file")


def _baseline_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return led.ledger_rows(_change_stats(spark, sf_dir, 0))


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return led.list_files(spark, corpus_dir(spark, sf_dir, corpora.revisions), folder_name)


@query
def pending_files(spark, sf_dir):
    listed = _listed(spark, sf_dir)
    return led.pending_files(listed, _baseline_ledger(spark, sf_dir)).select("phase", "file")


@query
def queued_counts(spark, sf_dir):
    return led.queued_counts(_listed(spark, sf_dir), _baseline_ledger(spark, sf_dir))


def _json_round_trip(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = new_dir(spark, "json")
    exports.write_documents_json(docs, path)
    return exports.read_documents_json(spark, path)


@query
def read_doc_json(spark, sf_dir):
    docs = _docs(spark, sf_dir, corpora.articles, DOC_FIELDS)
    return _flat(_json_round_trip(spark, docs))


@query
def write_doc_json(spark, sf_dir):
    docs = _docs(spark, sf_dir, corpora.texts, ("title", "abstract", "article_types"))
    back = _json_round_trip(spark, docs)
    return back.select("pmid", "title", "abstract", _joined(F.col("article_types")).alias("types"))


@query
def ledger_files(spark, sf_dir):
    path = new_dir(spark, "ledger")
    exports.write_table(_baseline_ledger(spark, sf_dir), path)
    return led.ledger_files(spark.read.parquet(path))


# Keyed tables -------------------------------------------------------------------------------


def _changes(
    spark: SparkSession, sf_dir: str, store_raw: bool = False, phase: int | None = None
) -> DataFrame:
    return tab.changes(_revisions(spark, sf_dir, phase), ("title",), store_raw)


def _titled(rows: DataFrame) -> DataFrame:
    return rows.select("pmid", F.col("doc.title").alias("title"), "file")


@query
def upsert_latest(spark, sf_dir):
    """Last version per id, deletions left aside."""
    return _titled(tab.latest(tab.upserts(_changes(spark, sf_dir))))


@query
def upsert_raw(spark, sf_dir):
    rows = tab.latest(tab.upserts(_changes(spark, sf_dir, store_raw=True)))
    title = F.regexp_extract("raw_xml", "<ArticleTitle>(.*?)</ArticleTitle>", 1)
    return rows.select("pmid", "file", title.alias("title"))


@query
def insert_if_absent(spark, sf_dir):
    """Baseline documents, plus the first update of each id they do not hold."""
    target = tab.apply_deletes(_changes(spark, sf_dir, phase=0))
    batch = tab.upserts(_changes(spark, sf_dir, phase=1))
    return _titled(tab.insert_if_absent(target, batch))


@query
def apply_deletes(spark, sf_dir):
    return _titled(tab.apply_deletes(_changes(spark, sf_dir)))


@query
def remove_listed_ids(spark, sf_dir):
    """One-off delete: the texts of labelled documents leave the table."""
    docs = _docs(spark, sf_dir, corpora.texts, ("title",))
    gone = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("pmid"))
    return tab.remove_ids(docs, gone)


@query
def file_ledger(spark, sf_dir):
    """Ledger after two runs: the second run's entry replaces the first's."""
    done = led.ledger_rows(_change_stats(spark, sf_dir))
    first = done.withColumns({"article_cnt": F.lit(0).cast("bigint"), "run": F.lit(1)})
    return led.ledger_current(first.unionByName(done.withColumn("run", F.lit(2))))


@query
def lookup_docs(spark, sf_dir):
    docs = _docs(spark, sf_dir, corpora.texts, ("title", "abstract"))
    return tab.lookup(docs, table(spark, sf_dir, "labels").select("doc_id"))


@query
def lookup_raw(spark, sf_dir):
    raw = rec.raw_split(corpus(spark, sf_dir, corpora.texts))
    found = tab.lookup(raw, table(spark, sf_dir, "labels").select("doc_id"))
    kind = F.regexp_extract("raw_xml", '<PublicationType UI="L">([^<]*)<', 1)
    return found.select("pmid", "file", kind.alias("lang"))


def _loaded(spark: SparkSession, sf_dir: str, phase: int | None) -> CitationStore:
    store = CitationStore.create(spark, new_dir(spark, "store"))
    store.load(corpus_dir(spark, sf_dir, corpora.revisions), phase, name=folder_name)
    return store


def _cut_first(spark: SparkSession, path: str, folder: str) -> None:
    """Cut the compressed stream of the first file of ``folder`` in half, in a task, as an
    interrupted copy would leave it."""
    import pyarrow as pa
    from pyarrow import fs

    def cut(batches):
        system, base = fs.FileSystem.from_uri(f"{path}/folder={folder}")
        first = min(i.path for i in system.get_file_info(fs.FileSelector(base)) if "file=" in i.path)
        part = min(i.path for i in system.get_file_info(fs.FileSelector(first)) if i.path.endswith(".gz"))
        with system.open_input_stream(part, compression=None) as f:
            data = f.read()
        with system.open_output_stream(part, compression=None) as f:
            f.write(data[: len(data) // 2])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["id"])

    # One partition: every task of the job cuts the file, and two at once may leave it empty.
    spark.range(0, 1, 1, 1).mapInArrow(cut, "id LONG").collect()


def _beside_damaged(spark: SparkSession, sf_dir: str) -> CitationStore:
    """A store loaded from the revisions in root elements, the first baseline file cut short."""
    path = corpora.with_root(spark, sf_dir, corpora.revisions)
    _cut_first(spark, path, "baseline")
    store = CitationStore.create(spark, new_dir(spark, "store"))
    store.load(path, name=folder_name)
    return store


@query
def load_beside_damaged(spark, sf_dir):
    """Current documents after a load in which one file is damaged: the others load."""
    return _beside_damaged(spark, sf_dir).documents().select("pmid", "title", "source_file")


@query
def bad_files(spark, sf_dir):
    """Files that a load found damaged."""
    return _beside_damaged(spark, sf_dir).bad_files().select("file")


@query
def load_progress(spark, sf_dir):
    """The progress row of a load of all revisions: files, articles and damaged files."""
    return _loaded(spark, sf_dir, None).progress().select("files", "article_cnt", "damaged")


@query
def reset_tables(spark, sf_dir):
    """Rows of each table after a load, and after the reset that follows it."""
    store = _loaded(spark, sf_dir, None)

    def sizes() -> dict[str, int]:
        tables = {"documents": store.documents(), "ledger": store.ledger()}
        return {name: rows.count() for name, rows in tables.items()}

    before = sizes()
    store.reset()
    after = sizes()
    return spark.createDataFrame(
        [(name, before[name], after[name]) for name in before],
        "table_name STRING, rows_before BIGINT, rows_after BIGINT",
    )


@query
def compressed_roundtrip(spark, sf_dir):
    """Documents and raw records written with a codec and read back."""
    made = parse_records(corpus(spark, sf_dir, corpora.texts), ("title", "abstract"))
    path = new_dir(spark, "zstd")
    loaded = made.where(F.col("error").isNull())
    exports.write_table(loaded.select("pmid", "title", "abstract", "raw_xml"), path)
    kind = F.regexp_extract("raw_xml", '<PublicationType UI="L">([^<]*)<', 1)
    return spark.read.parquet(path).select("pmid", "title", "abstract", kind.alias("lang"))


@query
def reprocess_raw(spark, sf_dir):
    """Documents from stored raw records, without the files."""
    path = new_dir(spark, "raw")
    records = corpus(spark, sf_dir, corpora.articles)
    exports.write_table(records.select("file", "kind", "raw_xml"), path)
    docs = documents(spark.read.parquet(path), ("title", "pub_date", "doi"))
    return docs


# Projections --------------------------------------------------------------------------------


@query
def doc_pmid(spark, sf_dir):
    return _docs(spark, sf_dir, corpora.texts, ()).select("pmid")


@query
def doc_title(spark, sf_dir):
    return _docs(spark, sf_dir, corpora.texts, ("title",)).select("pmid", "title")


@query
def doc_title_full(spark, sf_dir):
    """Titles as their whole text, inline tags' text included."""
    return _docs(spark, sf_dir, corpora.texts, ("full_title",)).select("pmid", F.col("full_title").alias("title"))


@query
def doc_abstract(spark, sf_dir):
    return _docs(spark, sf_dir, corpora.texts, ("abstract",)).select("pmid", "abstract")


@query
def node_text(spark, sf_dir):
    """Text of every abstract part on its own."""
    docs = _docs(spark, sf_dir, corpora.texts, ("abstract_parts",))
    parts = docs.select("pmid", F.posexplode("abstract_parts").alias("part", "node"))
    return parts.select("pmid", "part", text_of_node(F.col("node._VALUE")).alias("text"))


@query
def doc_article_types(spark, sf_dir):
    docs = _docs(spark, sf_dir, corpora.texts, ("article_types",))
    return docs.select("pmid", _joined(F.col("article_types")).alias("article_types"))


@query
def doc_authors(spark, sf_dir):
    docs = _docs(spark, sf_dir, corpora.articles, ("authors",))
    return docs.select("pmid", _joined(F.col("authors")).alias("authors"))


@query
def doc_pub_date(spark, sf_dir):
    return _docs(spark, sf_dir, corpora.articles, ("pub_date",)).select("pmid", "pub_date")


@query
def medline_year(spark, sf_dir):
    docs = _docs(spark, sf_dir, corpora.articles, ("medline_text",))
    year = year_of_text(F.col("medline_text"), F.lit("1900"))
    return docs.select(
        "pmid", F.when(F.col("medline_text").isNotNull(), year).alias("medline_year")
    )


@query
def doc_journal(spark, sf_dir):
    docs = _docs(spark, sf_dir, corpora.articles, ("journal_title", "journal_iso_title"))
    return docs.select("pmid", "journal_title", "journal_iso_title")


@query
def doc_doi(spark, sf_dir):
    return _docs(spark, sf_dir, corpora.articles, ("doi",)).select("pmid", "doi")


@query
def doc_doi_own(spark, sf_dir):
    """DOIs of the records themselves, without those of cited works."""
    docs = _docs(spark, sf_dir, corpora.articles, ("own_doi",))
    return docs.select("pmid", F.col("own_doi").alias("doi"))


@query
def doc_compounds(spark, sf_dir):
    docs = _docs(spark, sf_dir, corpora.articles, ("compounds",))
    return docs.select("pmid", _terms(F.col("compounds")).alias("compounds"))


@query
def doc_mesh(spark, sf_dir):
    """Headings without the ids that are compounds."""
    docs = _docs(spark, sf_dir, corpora.articles, ("mesh",))
    return docs.select("pmid", _terms(F.col("mesh")).alias("mesh"))


@query
def doc_mesh_live(spark, sf_dir):
    """All headings."""
    docs = _docs(spark, sf_dir, corpora.articles, ("mesh_all",))
    return docs.select("pmid", _terms(F.col("mesh_all")).alias("mesh"))


@query
def doc_source_file(spark, sf_dir):
    return _docs(spark, sf_dir, corpora.texts, ()).select("pmid", "source_file")


@query
def book_docs(spark, sf_dir):
    return _flat(documents(corpus(spark, sf_dir, corpora.books, kind=BOOK)))


@query
def doc_full(spark, sf_dir):
    return _flat(_docs(spark, sf_dir, corpora.articles, DOC_FIELDS))


@query
def abstract_html(spark, sf_dir):
    docs = _docs(spark, sf_dir, corpora.texts, ("abstract_html",))
    return docs.select("pmid", "abstract_html")


@query
def created_date(spark, sf_dir):
    docs = _docs(spark, sf_dir, corpora.texts, ("created_date",))
    return docs.select("pmid", F.col("created_date").cast("string").alias("created_date"))


@query
def search_source_rows(spark, sf_dir):
    rows = search_rows(corpus(spark, sf_dir, corpora.texts))
    source = F.col("source")
    return rows.select(
        "pmid", source["title"].alias("title"),
        source["created_date"].cast("string").alias("created_date"),
        source["abstract"].alias("abstract"),
    )


# Dispatch -----------------------------------------------------------------------------------


def _kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir, corpora.kinds)


@query
def kind_counts(spark, sf_dir):
    return rec.kind_counts(_kinds(spark, sf_dir))


@query
def unhandled_kinds(spark, sf_dir):
    return rec.unhandled_kinds(_kinds(spark, sf_dir))


@query
def deleted_ids(spark, sf_dir):
    return rec.deleted_ids(_kinds(spark, sf_dir))


# Statistics ---------------------------------------------------------------------------------


@query
def file_counts(spark, sf_dir):
    return stats.file_counts(_kinds(spark, sf_dir))


@query
def nonempty_files(spark, sf_dir):
    return stats.nonempty_files(stats.file_counts(_kinds(spark, sf_dir)))


@query
def file_rates(spark, sf_dir):
    rated = stats.file_rates(_change_stats(spark, sf_dir), WORKERS)
    return rated.withColumns({
        name: F.round(name, 6) for name in ("rate", "estimated_rate")
    })


@query
def total_rate(spark, sf_dir):
    """The latest file's time stands in for the time of the whole load."""
    timed = _change_stats(spark, sf_dir).withColumn("elapsed", F.col("duration"))
    return stats.total_rate(timed).withColumn("total_rate", F.round("total_rate", 6))


@query
def progress_blocks(spark, sf_dir):
    marks = stats.progress_blocks(_change_stats(spark, sf_dir), every=1000)
    return marks.withColumns({name: F.round(name, 4) for name in ("elapsed", "rate")})


# Data quality -------------------------------------------------------------------------------


@query
def missing_titles(spark, sf_dir):
    return quality.missing_titles(corpus(spark, sf_dir, corpora.texts))


@query
def bad_dates(spark, sf_dir):
    return quality.bad_dates(corpus(spark, sf_dir, corpora.articles))


@query
def bad_records(spark, sf_dir):
    bad = quality.bad_records(corpus(spark, sf_dir, corpora.texts))
    return bad.select("file", "error", rec.versioned_id(F.col("raw_xml")).alias("raw_id"))


@query
def missing_ids(spark, sf_dir):
    return quality.missing_raw_ids(corpus(spark, sf_dir, corpora.texts)).groupBy("file").agg(
        F.count("*").alias("records")
    )


@query
def id_mismatch(spark, sf_dir):
    """Labelled documents as requests; a toxic one is answered with the record after it."""
    labels = table(spark, sf_dir, "labels")
    requests = labels.select(
        F.col("doc_id").cast("string").alias("requested"),
        (F.col("doc_id") + F.col("toxic")).cast("string").alias("raw_key"),
    )
    made = parse_records(corpus(spark, sf_dir, corpora.texts), ())
    served = made.where(F.col("error").isNull()).select(
        rec.versioned_id(F.col("raw_xml")).alias("raw_key"), "pmid"
    )
    return quality.id_mismatch(requests, served)


# Loads --------------------------------------------------------------------------------------


def _store_rows(store: CitationStore) -> DataFrame:
    return store.documents().select("pmid", "title", "source_file")


@query
def load_baseline(spark, sf_dir):
    return _store_rows(_loaded(spark, sf_dir, 0))


@query
def load_updates(spark, sf_dir):
    """Updates on top of a compacted baseline."""
    store = _loaded(spark, sf_dir, 0)
    store.compact()
    store.load(corpus_dir(spark, sf_dir, corpora.revisions), 1, name=folder_name)
    return _store_rows(store)


@query
def stream_load(spark, sf_dir):
    root = new_dir(spark, "stream")
    store = CitationStore.create(spark, root)
    data_dir = corpus_dir(spark, sf_dir, corpora.revisions)
    running = start_stream(store, data_dir, f"{root}/checkpoint", name=folder_name)
    running.awaitTermination()
    return _store_rows(store)


# Changes of a stored table -------------------------------------------------------------------


@query
def reopened_lookup(spark, sf_dir):
    """Suppliers' keys looked up in a store that was made with other buckets and opened again."""
    root = new_dir(spark, "store")
    store = CitationStore.create(spark, root, buckets=16)
    store.load(corpus_dir(spark, sf_dir, corpora.revisions), name=folder_name)
    store.compact()
    found = CitationStore(spark, root).lookup(table(spark, sf_dir, "supplier").select("s_suppkey"))
    return found.select("pmid", "title", "source_file")


@query
def delete_stored(spark, sf_dir):
    """Suppliers' keys deleted from a compacted store."""
    store = _loaded(spark, sf_dir, None)
    store.compact()
    store.delete(table(spark, sf_dir, "supplier").select("s_suppkey"))
    return _store_rows(store)


@query
def reprocess_store(spark, sf_dir):
    """Stored raw records parsed again, on top of a compacted store."""
    store = CitationStore.create(spark, new_dir(spark, "store"))
    store.load(corpus_dir(spark, sf_dir, corpora.revisions), name=folder_name, store_raw=True)
    store.compact()
    store.reprocess()
    return _store_rows(store)


@query
def json_insert_if_absent(spark, sf_dir):
    """Documents of the update files, by way of JSON, into a store of the baseline."""
    store = _loaded(spark, sf_dir, 0)
    updates = _revisions(spark, sf_dir, 1)
    store.insert_absent(_json_round_trip(spark, documents(updates, DOC_FIELDS)))
    return _store_rows(store)


@query
def ledger_counts(spark, sf_dir):
    """Statistics of the files of a load, from its ledger; times are not compared."""
    return _loaded(spark, sf_dir, None).file_stats().select("phase", "file", "article_cnt")
