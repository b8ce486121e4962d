"""A damaged file beside good ones: the good ones load, the damaged one is listed and waits."""

import gzip
import os

from citeflow import CitationStore
from citeflow.streaming.load import stream_load
from tests.samples import article, deletes, write_file


def _cut(path):
    """Keep the first half of the compressed stream, as an interrupted copy would."""
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(data[: len(data) // 2])


def _files(folder):
    write_file(folder / "baseline", "good.xml.gz", article(101), article(102))
    # Long enough that half of the stream ends inside the records.
    many = [article(200 + i, f"<ArticleTitle>{'word ' * 50}{i}</ArticleTitle>") for i in range(200)]
    write_file(folder / "baseline", "cut.xml.gz", *many)
    _cut(str(folder / "baseline" / "cut.xml.gz"))
    write_file(folder / "updatefiles", "upd.xml.gz", article(103), deletes(101))


def _ids(store):
    return sorted(int(r.pmid) for r in store.documents().select("pmid").collect())


def test_damaged_file_stays_out_and_loads_once_repaired(spark, tmp_path):
    data = tmp_path / "data"
    _files(data)
    store = CitationStore.create(spark, str(tmp_path / "store"))
    assert store.load(str(data)) == 3
    assert _ids(store) == [102, 103]
    assert sorted(r.fn for r in store.ledger().collect()) == ["baseline/good.xml.gz", "updatefiles/upd.xml.gz"]
    assert [(r.file,) for r in store.bad_files().collect()] == [("baseline/cut.xml.gz",)]
    assert store.bad_records().count() == 0  # the cut record of the damaged file is not there either
    # Still damaged: taken again, listed again, nothing new.
    assert store.load(str(data)) == 1
    assert _ids(store) == [102, 103] and store.bad_files().count() == 1
    write_file(data / "baseline", "cut.xml.gz", *[article(200 + i) for i in range(200)])
    assert store.load(str(data)) == 1
    assert _ids(store) == [102, 103] + list(range(200, 400))
    assert store.bad_files().count() == 0
    store.compact()
    assert _ids(store) == [102, 103] + list(range(200, 400))


def test_damaged_file_in_a_stream(spark, tmp_path):
    data = tmp_path / "data"
    _files(data)
    store = CitationStore.create(spark, str(tmp_path / "store"))
    stream_load(store, str(data), str(tmp_path / "checkpoint"), files_per_batch=1).awaitTermination(120)
    assert _ids(store) == [102, 103]
    assert [r.file for r in store.bad_files().collect()] == ["baseline/cut.xml.gz"]
    write_file(data / "baseline", "cut.xml.gz", article(200))
    assert store.load(str(data)) == 1
    assert _ids(store) == [102, 103, 200] and store.bad_files().count() == 0


def test_files_without_root_are_taken_as_they_are(spark, tmp_path):
    folder = tmp_path / "data" / "baseline"
    os.makedirs(folder)
    with gzip.open(folder / "bare.xml.gz", "wt") as out:
        out.write(article(7) + "\n" + article(8) + "\n")
    store = CitationStore.create(spark, str(tmp_path / "store"))
    store.load(str(tmp_path / "data"))
    assert _ids(store) == [7, 8] and store.bad_files().count() == 0
