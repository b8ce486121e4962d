import gzip
import io

import pytest

from citeflow.llm import warc
from citeflow.plans.workspace import new_dir

ROWS = [
    (1, "http://a.example/x y", "<p>one</p>", 5), (2, None, "<p>one</p>", 5), (3, "u", "", 5),
    (4, "u", None, 5), (5, "ü\r\nX: y", "é" * 200_000, 5), (None, "u", "<p>one</p>", 5), (None, "u", "alone", 5),
    (7, "u", "twice", 5), (7, "u", "twice", 5), (-9, "u", "twice", 5), (8, "u", "\r\n\r\nWARC/1.1\r\n", 5),
]
SCHEMA = "page_id BIGINT, url STRING, html STRING, payload INT"


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    archives = warc.write(pages, new_dir(spark, "w"))
    assert archives.agg({"records": "sum"}).first()[0] == len(ROWS)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.read(archives).collect()), key=repr)
    largest = {}
    for k, _, html, _ in ROWS:
        if k is not None:
            largest[html or ""] = max(largest.get(html or "", k), k)
    want = []
    for k, _, html, _ in ROWS:
        top, data = largest.get(html or ""), (html or "").encode()
        revisit = top is not None and k != top
        want.append((k, "revisit" if revisit else "response", top if revisit else None, len(data), warc.digest(data)))
    assert got == sorted(want, key=repr)
    full = {r.page_id: bytes(r.payload) for r in warc.read(archives).where("record_type = 'response'").collect()}
    assert full[5] == ("é" * 200_000).encode() and full[8] == b"\r\n\r\nWARC/1.1\r\n" and full[4] == b""


def test_short_payloads_are_all_responses(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    got = warc.read(warc.write(pages, new_dir(spark, "w"), min_bytes=6))
    assert sorted(r.page_id for r in got.where("record_type = 'revisit' AND page_id IS NOT NULL").collect()) == [1]


def test_empty_table(spark):
    assert warc.read(warc.write(spark.createDataFrame([], SCHEMA), new_dir(spark, "w"))).count() == 0


def test_one_member_per_record_and_small_reads(monkeypatch):
    monkeypatch.setattr(warc, "PIECE", 7)
    records = [warc.page_record(k, "u", b"x" * k, None) for k in range(5)]
    data = b"".join(records)
    assert len(gzip.decompress(records[3])) > 0
    read = [warc.parse_page(warc.parse_record(m)) for m in warc.members(io.BytesIO(data))]
    assert [(r[0], r[3]) for r in read] == [(k, k) for k in range(5)]
    with pytest.raises(warc.DamagedArchive):
        list(warc.members(io.BytesIO(data[:-9])))


def test_damage_is_found():
    plain = gzip.decompress(warc.page_record(1, "u", b"payload", None))
    for bad in (plain.replace(b"payload\r\n", b"paYload\r\n"), plain[:-5], plain.replace(b"WARC/1.1", b"XXXX/1.1")):
        with pytest.raises(warc.DamagedArchive):
            warc.parse_page(warc.parse_record(bad))


def test_ids_of_all_signs():
    assert [warc.page_of(warc.record_urn(k)) for k in (0, 5, -1, 2**63 - 1, -2**63, None)] == [0, 5, -1, 2**63 - 1, -2**63, None]
