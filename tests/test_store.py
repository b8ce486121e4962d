import os
import shutil

import pytest
from pyspark.sql import functions as F

from citeflow.operators import stats
from citeflow.plans.store import CitationStore, _spread
from citeflow.schema import BOOK
from citeflow.sources.records import read_records, relative_to
from citeflow.streaming.load import stream_load
from tests.samples import article, book, deletes, titled, write_file


def versions(store):
    return {r.pmid: (r.title, r.source_file) for r in store.documents().collect()}


@pytest.fixture
def data(tmp_path):
    folder = tmp_path / "data"
    write_file(
        folder, "baseline/n1.xml.gz", article("1", title=titled("one")),
        article("2", title=titled("two")), article("3", title=titled("three")),
        article("3", title=titled("three again")),
    )
    write_file(folder, "baseline/n2.xml.gz", book("4"), article("2", title=titled("two n2")))
    write_file(
        folder, "updatefiles/n3.xml.gz", article("1", title=titled("one new")), deletes("2", "4"),
        article(None), article("9").replace("</Article>", ""),
    )
    write_file(folder, "updatefiles/n4.xml.gz", article("2", title=titled("two back")), "<Odd/>")
    write_file(folder, "updatefiles/n5.xml.gz", deletes("3"))
    write_file(folder, "updatefiles/n6.xml.gz")
    return str(folder)


FINAL = {"1": ("one new", "updatefiles/n3.xml.gz"), "2": ("two back", "updatefiles/n4.xml.gz")}
COUNTS = {
    "baseline/n1.xml.gz": 4, "baseline/n2.xml.gz": 2, "updatefiles/n3.xml.gz": 3,
    "updatefiles/n4.xml.gz": 1, "updatefiles/n5.xml.gz": 0, "updatefiles/n6.xml.gz": 0,
}


def new_store(spark, tmp_path):
    return CitationStore.create(spark, str(tmp_path / "store"), buckets=4)


def test_load_resume_compact(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    assert versions(store) == {}
    assert store.load(data, phase=0) == 2
    assert versions(store) == {
        "1": ("one", "baseline/n1.xml.gz"), "2": ("two n2", "baseline/n2.xml.gz"),
        "3": ("three again", "baseline/n1.xml.gz"), "4": ("B", "baseline/n2.xml.gz"),
    }
    store.compact()
    assert len(versions(store)) == 4
    assert store.load(data) == 4
    assert versions(store) == FINAL
    assert store.load(data) == 0
    assert {r.fn: r.article_cnt for r in store.ledger().collect()} == COUNTS
    store.compact()
    store.compact()
    assert versions(store) == FINAL
    assert {r.error for r in store.bad_records().collect()} == {"malformed xml", "no record id"}
    assert [(r.kind, r.file) for r in store.unhandled().collect()] == [
        ("Odd", "updatefiles/n4.xml.gz")
    ]
    assert [r.title for r in store.lookup(["1", 3]).collect()] == ["one new"]
    ids = spark.createDataFrame([(2,), (3,)], "id INT")
    assert [r.title for r in store.lookup(ids).collect()] == ["two back"]
    store.reset_ledger()
    assert store.ledger().count() == 0 and versions(store) == FINAL
    assert store.load(data) == 6
    assert versions(store) == FINAL and store.ledger().count() == 6
    store.reset()
    assert versions(store) == {} and store.ledger().count() == 0


def test_late_old_file_does_not_revive_a_deleted_record(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    late = os.path.join(data, "baseline", "n1.xml.gz")
    kept = str(tmp_path / "n1.xml.gz")
    shutil.move(late, kept)
    store.load(data)
    store.compact()
    shutil.move(kept, late)
    assert store.load(data) == 1
    assert versions(store) == FINAL


def test_raw_is_stored_on_request(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    store.load(data, phase=0)
    assert store.raw().count() == 0
    store.reset()
    store.load(data, store_raw=True)
    raw = {r.pmid: r.raw_xml for r in store.raw().collect()}
    assert set(raw) == {"1", "2"} and "one new" in raw["1"]
    assert "one new" in store.lookup_raw(["1"]).first().raw_xml


def test_the_log_is_merged_the_same_way_at_any_size(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    store.load(data, phase=0)
    store.compact()
    store.load(data)
    assert versions(store) == FINAL
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert versions(store) == FINAL
        store.compact()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert versions(store) == FINAL


def test_reopened_store_keeps_its_buckets_and_tables(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    store.load(data)
    store.compact()
    again = CitationStore(spark, store.root)
    assert again.buckets == 4 and {r.title for r in again.lookup(["1", "2"]).collect()} == {"one new", "two back"}
    assert versions(CitationStore.create(spark, store.root)) == FINAL
    with pytest.raises(ValueError):
        CitationStore.create(spark, store.root, buckets=8)
    with pytest.raises(FileNotFoundError):
        CitationStore(spark, str(tmp_path / "nowhere"))


def test_reset_empties_under_dynamic_overwriting(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    store.load(data)
    store.compact()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store.reset()
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert versions(store) == {} and store.ledger().count() == 0 and store.load(data) == 6


@pytest.mark.parametrize("compacted", [False, True])
def test_reloaded_file_replaces_its_old_version(spark, tmp_path, data, compacted):
    store = new_store(spark, tmp_path)
    store.load(data)
    if compacted:
        store.compact()
    write_file(data, "updatefiles/n4.xml.gz", article("2", title=titled("two corrected")))
    store.reset_ledger()
    assert store.load(data) == 6
    assert versions(store) == {**FINAL, "2": ("two corrected", "updatefiles/n4.xml.gz")}


@pytest.mark.parametrize("compacted", [False, True])
def test_two_streams_do_not_touch_each_other(spark, tmp_path, compacted):
    store, want = new_store(spark, tmp_path), {}
    for k in (1, 2):
        folder = tmp_path / f"folder{k}"
        write_file(folder, f"updatefiles/s{k}.xml.gz", article(str(k), title=titled(f"from {k}")))
        stream_load(store, str(folder), str(tmp_path / f"checkpoint{k}")).awaitTermination(120)
        want[str(k)] = (f"from {k}", f"updatefiles/s{k}.xml.gz")
        if compacted:
            store.compact()
    assert versions(store) == want and store.ledger().count() == 2


def test_finished_batch_is_not_written_again(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    records = read_records(spark, data, relative_to(data))
    store.write_batch("b1", records)
    store.write_batch("b1", records.where("false"))
    assert versions(store) == FINAL


@pytest.mark.parametrize("how", ["batch", "stream"])
def test_folders_with_odd_names(spark, tmp_path, data, how):
    folder = str(tmp_path / "my data+100% é")
    shutil.copytree(data, folder)
    write_file(folder, "updatefiles/more of + it.xml.gz", article("8", title=titled("eight")))
    with open(os.path.join(folder, "updatefiles", "index.html"), "w") as f:
        f.write("<html></html>")
    store = new_store(spark, tmp_path)
    if how == "batch":
        assert store.load(folder) == 7
    else:
        stream_load(store, folder, str(tmp_path / "checkpoint")).awaitTermination(120)
    assert versions(store) == {**FINAL, "8": ("eight", "updatefiles/more of + it.xml.gz")}
    counts = {r.fn: r.article_cnt for r in store.ledger().collect()}
    assert {k: v for k, v in counts.items() if v} == {
        **{k: v for k, v in COUNTS.items() if v}, "updatefiles/more of + it.xml.gz": 1}
    assert store.load(folder) == (0 if how == "batch" else 1)  # a file without records


def test_stream_skips_what_the_ledger_has(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    store.load(data)
    before = store.ledger().count()
    stream_load(store, data, str(tmp_path / "checkpoint")).awaitTermination(120)
    assert versions(store) == FINAL and store.ledger().count() == before


def test_uneven_files_are_spread(spark, tmp_path, data, monkeypatch):
    assert _spread([1 << 30], 8) == 64 and _spread([1 << 25] * 64, 8) is None
    assert _spread([1 << 20], 8) is None
    monkeypatch.setattr("citeflow.plans.store._spread", lambda *_: 5)
    store = new_store(spark, tmp_path)
    store.load(data)
    assert versions(store) == FINAL


def test_lookup_prunes_buckets(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    store.load(data)
    store.compact()
    plan = store.lookup(["1"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "Window" not in plan


def test_unfinished_batch_is_invisible(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    store.load(data, phase=0)
    before = versions(store)
    ledger = str(tmp_path / "store" / "ledger")
    known = set(os.listdir(ledger))
    store.load(data)
    (batch,) = (d for d in os.listdir(ledger) if d not in known and d.startswith("batch="))
    shutil.move(os.path.join(ledger, batch), str(tmp_path / batch))
    assert versions(store) == before


@pytest.mark.parametrize("order", ["forward", "backward"])
def test_stream_gives_the_same_view_in_any_order(spark, tmp_path, data, order):
    names = sorted(COUNTS)
    for age, name in enumerate(names if order == "forward" else reversed(names)):
        os.utime(os.path.join(data, name), (1_600_000_000 + age * 60,) * 2)
    store = new_store(spark, tmp_path)
    checkpoint = str(tmp_path / "checkpoint")
    query = stream_load(store, data, checkpoint, files_per_batch=2)
    query.awaitTermination(120)
    assert query.exception() is None
    assert versions(store) == FINAL
    files = {r.fn: r.article_cnt for r in store.ledger().collect()}
    assert files == {f: n for f, n in COUNTS.items() if f != "updatefiles/n6.xml.gz"}

    write_file(data, "updatefiles/n7.xml.gz", article("7", title=titled("seven")))
    again = stream_load(store, data, checkpoint, files_per_batch=2)
    again.awaitTermination(120)
    assert sum(p.numInputRows > 0 for p in again.recentProgress) == 1
    assert set(versions(store)) == {"1", "2", "7"}


@pytest.mark.parametrize("compacted", [False, True])
def test_delete_by_id_and_state_again(spark, tmp_path, data, compacted):
    store = new_store(spark, tmp_path)
    store.load(data)
    if compacted:
        store.compact()
    store.delete([2, "none"])
    assert versions(store) == {"1": FINAL["1"]}
    store.delete(spark.createDataFrame([(1,)], "id INT"))
    assert versions(store) == {} and store.ledger().count() == 6 and store.load(data) == 0
    if compacted:
        store.compact()
    write_file(data, "updatefiles/n9.xml.gz", article("2", title=titled("two at last")))
    store.load(data)
    assert versions(store) == {"2": ("two at last", "updatefiles/n9.xml.gz")}
    store.reset_ledger()
    store.load(data)
    assert set(versions(store)) == {"1", "2"}


@pytest.mark.parametrize("compacted", [False, True])
def test_insert_absent_keeps_what_is_there(spark, tmp_path, data, compacted):
    store = new_store(spark, tmp_path)
    store.load(data)
    if compacted:
        store.compact()
    docs = spark.createDataFrame(
        [("1", "other", "b.json"), ("3", "back", "b.json"), ("30", "second", "b.json"),
         ("30", "first", "a.json"), (None, "nobody", "a.json")], "pmid STRING, title STRING, source_file STRING")
    store.insert_absent(docs)
    store.insert_absent(docs.withColumn("title", F.lit("late")))
    want = {**FINAL, "3": ("back", "b.json"), "30": ("first", "a.json")}
    assert versions(store) == want
    write_file(data, "baseline/a0.xml.gz", article("30", title=titled("from a file")))
    store.load(data)
    assert versions(store) == {**want, "30": ("from a file", "baseline/a0.xml.gz")}


@pytest.mark.parametrize("compacted", [False, True])
def test_reprocess_from_stored_raw_records(spark, tmp_path, compacted):
    heading = '<MeshHeadingList><MeshHeading><DescriptorName UI="D1">h</DescriptorName></MeshHeading></MeshHeadingList>'
    chemical = '<ChemicalList><Chemical><NameOfSubstance UI="D1">c</NameOfSubstance></Chemical></ChemicalList>'
    folder = tmp_path / "data"
    path = write_file(folder, "baseline/n1.xml.gz", article("1", chemicals=chemical, headings=heading), article("2"))
    store = new_store(spark, tmp_path)
    store.load(str(folder), store_raw=True)
    if compacted:
        store.compact()
    os.remove(path)

    def mesh():
        return {r.pmid: [m.id for m in r.mesh] for r in store.documents().collect()}

    assert mesh() == {"1": [], "2": []}
    store.reprocess(choose={"mesh": "mesh_all"})
    assert mesh() == {"1": ["MESH:D1"], "2": []}
    store.reprocess()
    assert mesh() == {"1": [], "2": []} and store.raw().count() == 2 and store.ledger().count() == 1


def test_statistics_of_a_loaded_store(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    store.load(data, phase=0)
    store.load(data)
    rated = {r.file: r for r in stats.file_rates(store.file_stats(), 10).collect()}
    assert {f: r.article_cnt for f, r in rated.items()} == COUNTS
    assert {r.phase for f, r in rated.items() if f.startswith("baseline")} == {0}
    assert rated["baseline/n1.xml.gz"].estimated_rate > rated["baseline/n1.xml.gz"].rate > 0
    total = stats.total_rate(store.file_stats()).first()
    spent = sum(r.duration for r in rated.values())
    assert total.article_cnt == 10 and total.total_rate == pytest.approx(10 / spent)
    marks = stats.progress_blocks(store.file_stats(), every=2).collect()
    assert sorted((r.phase, r.records) for r in marks) == [(0, 2), (0, 4), (0, 6), (1, 2), (1, 4)]


def test_lookup_of_a_table_reads_its_buckets_only(spark, tmp_path, data):
    store = new_store(spark, tmp_path)
    store.load(data)
    store.compact()
    plan = store.lookup(spark.createDataFrame([(1,)], "id INT"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "Window" not in plan


def test_book_files_stream_by_their_own_end_tag(spark, tmp_path):
    folder = tmp_path / "data"
    write_file(folder, "baseline/b.xml.gz", *(book(str(k)) for k in range(20)), root="PubmedBookArticleSet")
    store = new_store(spark, tmp_path)
    assert store.load(str(folder), kind=BOOK) == 1 and store.documents().count() == 20
