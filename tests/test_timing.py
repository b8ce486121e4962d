"""Durations in the ledger are measured per file, from the tasks that read it."""

from citeflow import CitationStore
from tests.samples import article, write_file


def test_costly_file_takes_longer(spark, tmp_path):
    data = tmp_path / "data"
    write_file(data / "baseline", "cheap.xml.gz", *[article(i) for i in range(1, 301)])
    long_title = "<ArticleTitle>" + "many words here " * 4000 + "</ArticleTitle>"
    write_file(data / "baseline", "costly.xml.gz", *[article(i, long_title) for i in range(1001, 1301)])
    store = CitationStore.create(spark, str(tmp_path / "store"))
    store.load(str(data))
    rows = {r.fn: r for r in store.ledger().collect()}
    cheap, costly = rows["baseline/cheap.xml.gz"], rows["baseline/costly.xml.gz"]
    assert cheap.article_cnt == costly.article_cnt == 300
    assert 0 < cheap.duration < costly.duration
    # Seconds of tasks: never more than the load's time on all cores.
    assert cheap.duration + costly.duration <= costly.elapsed * spark.sparkContext.defaultParallelism


def test_progress_rows_agree_with_the_ledger(spark, tmp_path):
    from citeflow.streaming.load import stream_load
    from tests.samples import deletes

    data = tmp_path / "data"
    write_file(data / "baseline", "a.xml.gz", *[article(i) for i in range(1, 51)])
    write_file(data / "baseline", "b.xml.gz", *[article(i) for i in range(51, 81)], deletes(3))
    store = CitationStore.create(spark, str(tmp_path / "store"))
    store.load(str(data))
    write_file(data / "updatefiles", "c.xml.gz", *[article(i) for i in range(81, 91)])
    stream_load(store, str(data), str(tmp_path / "checkpoint")).awaitTermination(120)
    rows = sorted(store.progress().collect(), key=lambda r: r.seq)
    ledger = store.ledger().collect()
    assert [(r.files, r.article_cnt, r.damaged) for r in rows] == [(2, 80, 0), (1, 10, 0)]
    assert sum(r.article_cnt for r in rows) == sum(r.article_cnt for r in ledger)
    assert sum(r.files for r in rows) == len(ledger)
    assert rows[0].chunks >= 80 and rows[1].elapsed >= rows[0].elapsed
