import gzip
import os

from citeflow.operators.ledger import list_files, pending_files, queued_counts
from citeflow.operators.documents import parse_records
from citeflow.schema import BOOK
from citeflow.sources.records import (
    deleted_ids, kind_counts, raw_split, read_records, relative_to, unhandled_kinds,
)
from tests.samples import article, book, deletes, titled, write_file


def scan(spark, folder, **kw):
    return read_records(spark, str(folder), relative_to(str(folder)), **kw)


def test_kinds_order_and_names(spark, tmp_path):
    write_file(
        tmp_path, "updatefiles/a.xml.gz", article("1"), book("2"), article("3"),
        deletes("4", "5", "6"), "<DeleteDocument/>", "<DeleteDocument>7</DeleteDocument>",
        "<BookDocument><PMID>8</PMID></BookDocument>", "<Odd x='1'/>", "<!-- note -->",
    )
    write_file(tmp_path, "baseline/b.xml.gz", article("9"))
    records = scan(spark, tmp_path)
    assert {r.kind: r.records for r in kind_counts(records).collect()} == {
        "PubmedArticle": 3, "PubmedBookArticle": 1, "DeleteCitation": 1, "DeleteDocument": 2,
        "BookDocument": 1, "Odd": 1,
    }
    rows = records.where("file = 'updatefiles/a.xml.gz'").orderBy("block", "ord").collect()
    assert [r.kind for r in rows][:4] == [
        "PubmedArticle", "PubmedBookArticle", "PubmedArticle", "DeleteCitation",
    ]
    assert {(r.file, r.phase) for r in records.select("file", "phase").collect()} == {
        ("updatefiles/a.xml.gz", 1), ("baseline/b.xml.gz", 0),
    }
    assert [r.pmid for r in deleted_ids(records).collect()] == ["4", "5", "6"]
    assert {(r.kind, r.records) for r in unhandled_kinds(records).collect()} == {
        ("DeleteDocument", 2), ("BookDocument", 1), ("Odd", 1),
    }


def test_files_without_the_separator(spark, tmp_path):
    write_file(tmp_path, "baseline/books.xml.gz", book("1"), book("2"), root="PubmedBookArticleSet")
    write_file(tmp_path, "updatefiles/gone.xml.gz", deletes("1", "2"))
    counts = {r.kind: r.records for r in kind_counts(scan(spark, tmp_path)).collect()}
    assert counts == {"PubmedBookArticle": 2, "DeleteCitation": 1}
    # The books' own end tag gives the same records, a chunk each.
    assert {r.kind: r.records for r in kind_counts(scan(spark, tmp_path, kind=BOOK)).collect()} == counts


def test_unclosed_record_spoils_only_itself(spark, tmp_path):
    open_record = article("2").replace("</PubmedArticle>", "")
    write_file(tmp_path, "baseline/a.xml.gz", article("1"), open_record, article("3"), article("4"))
    rows = raw_split(scan(spark, tmp_path)).collect()
    assert [r.pmid for r in rows] == ["1", "2", "3", "4"]
    parsed = parse_records(scan(spark, tmp_path), ()).collect()
    assert {r.pmid for r in parsed if not r.error} == {"1", "3", "4"}
    assert [r.error for r in parsed if r.error] == ["malformed xml"]


def test_unclosed_record_before_other_kinds(spark, tmp_path):
    open_record, open_book = (r.rsplit("</", 1)[0] for r in (article("1"), book("2")))
    write_file(tmp_path, "updatefiles/a.xml.gz", open_record, deletes("5"), open_book, book("3"), article("4"))
    rows = scan(spark, tmp_path)
    assert {r.kind: r.records for r in kind_counts(rows).collect()} == {
        "PubmedArticle": 2, "PubmedBookArticle": 2, "DeleteCitation": 1,
    }
    assert {r.pmid for r in parse_records(rows, ()).where("error IS NULL").collect()} == {"3", "4"}


def test_raw_split_needs_a_versioned_id(spark, tmp_path):
    write_file(
        tmp_path, "baseline/a.xml.gz", article("12"),
        article("13").replace(' Version="1"', ""), article(None),
    )
    assert [r.pmid for r in raw_split(scan(spark, tmp_path)).collect()] == ["12", None, None]


def test_plain_xml_keeps_order_across_splits(spark, tmp_path):
    path = os.path.join(str(tmp_path), "baseline", "big.xml")
    os.makedirs(os.path.dirname(path))
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(article(str(i), title=titled("é" * 50)) for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        records = scan(spark, tmp_path)
        assert records.rdd.getNumPartitions() > 3
        rows = raw_split(records.orderBy("file", "block", "ord")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [int(r.pmid) for r in rows] == list(range(3000))


def test_pending_files(spark, tmp_path):
    for name in ("baseline/b.xml.gz", "baseline/a.xml.gz", "updatefiles/c.xml.gz"):
        write_file(tmp_path, name, article("1"))
    with gzip.open(tmp_path / "baseline" / "notes.txt.gz", "wt") as out:
        out.write("x")
    files = list_files(spark, str(tmp_path), relative_to(str(tmp_path)))
    ledger = spark.createDataFrame([("baseline/a.xml.gz",)], "fn STRING")
    assert [r.file for r in pending_files(files, ledger).collect()] == [
        "baseline/b.xml.gz", "baseline/notes.txt.gz", "updatefiles/c.xml.gz",
    ]
    assert {tuple(r) for r in queued_counts(files, ledger).collect()} == {(0, 2, 1), (1, 1, 1)}
