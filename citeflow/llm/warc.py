"""WARC archives: one gzip member per record, written and read by tasks.

Records of equal payloads are written once in full: that of the largest id is a ``response``, the
others are ``revisit`` records that refer to it. The reader goes through a file once, feeds it to
zlib piece by piece, frames records by their Content-Length and checks their digests.

Defined results: a null or empty payload is empty, and equal to other empty ones; rows of a null
id revisit the largest id of their payload, or are responses if it has none; repeated rows of the
largest id are all responses; a null URL is left out; an empty table gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.llm.files import attempt_name, make_dir, open_read, open_write

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
LEVEL = 3
PIECE = 1 << 16
MANIFEST = "path STRING, records BIGINT"
ROW = (
    "page_id BIGINT, url STRING, payload BINARY, payload_bytes BIGINT, payload_digest STRING, "
    "record_type STRING, refers_to BIGINT"
)

# The upper half of a record's UUID says whether the lower half is an id.
_OF_ID, _NO_ID = 0x6369746566086C6F, 0x6369746566086E6F
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


class DamagedArchive(ValueError):
    """A record whose framing or digest is wrong."""


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def digest(data: bytes) -> str:
    """SHA-1 in base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_urn(page_id: int | None) -> str:
    if page_id is None:
        return uuid.UUID(int=_NO_ID << 64 | uuid.uuid4().int & (1 << 64) - 1).urn
    return uuid.UUID(int=_OF_ID << 64 | page_id & (1 << 64) - 1).urn


def page_of(urn: str) -> int | None:
    high, low = divmod(uuid.UUID(urn.strip("<>")).int, 1 << 64)
    return None if high != _OF_ID else low - (1 << 64) if low >> 63 else low


def encode_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    text = f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode()
    return packer.compress(text + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    http = _HTTP % len(payload)
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", f"<{record_urn(page_id)}>"), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    headers += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
                ("WARC-Block-Digest", f"sha1:{digest(block)}"),
                ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        headers += [("WARC-Refers-To", f"<{record_urn(refers_to)}>"), ("WARC-Profile", PROFILE)]
    return encode_record(headers, block)


def members(file) -> Iterator[bytes]:
    """Uncompressed content of each gzip member, inflated piece by piece."""
    left = file.read(PIECE)
    while left:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not left:
                raise DamagedArchive("the file ends inside a member")
            try:
                parts.append(inflate.decompress(left))
            except zlib.error as e:
                raise DamagedArchive(str(e)) from e
            left = inflate.unused_data if inflate.eof else file.read(PIECE)
        yield b"".join(parts)
        left = left or file.read(PIECE)


def parse_record(data: bytes) -> Record:
    """Framed by its Content-Length; digests of block and payload are verified."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise DamagedArchive("no record header")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    size = int(headers["content-length"])
    block = rest[:size]
    if len(block) < size or rest[size:] != b"\r\n\r\n":
        raise DamagedArchive("the record is not as long as it says")
    told = headers.get("warc-block-digest")
    if told and told != f"sha1:{digest(block)}":
        raise DamagedArchive("the block has another digest")
    return Record(headers, block)


def parse_page(record: Record) -> tuple | None:
    """A row as in ``ROW``; None for records that are no pages."""
    headers, kind = record.headers, record.headers.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = record.block.partition(b"\r\n\r\n")
    told = headers["warc-payload-digest"].removeprefix("sha1:")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    refers = None
    if kind == "revisit":
        payload, refers = None, page_of(headers["warc-refers-to"])
    elif len(payload) != size or digest(payload) != told:
        raise DamagedArchive("the payload has another length or digest")
    return (page_of(headers["warc-record-id"]), headers.get("warc-target-uri"), payload, size, told, kind, refers)


def with_referred(pages: DataFrame, page_id: str, url: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload`` and ``refers_to``, null for responses.

    The largest id of a payload is found by its hash, combined before the shuffle. The join back
    has one row on one side, so Spark may split a payload that very many pages share.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("key", F.unhex(F.sha2("payload", 256)))
    long = rows.where(F.octet_length("payload") >= min_bytes)
    largest = long.groupBy("key").agg(F.max("page_id").alias("largest"))
    joined = rows.join(largest, "key", "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("largest")).alias("refers_to"))


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url",
          payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes archives below ``path``, one for each task; gives their manifest."""
    folder = f"{path}/archives"
    make_dir(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, count = f"{folder}/{attempt_name('pages')}.warc.gz", None, 0
        for batch in batches:
            if batch.num_rows and file is None:
                file = open_write(name)
                info = b"format: WARC File Format 1.1\r\n"
                file.write(encode_record(
                    [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{record_urn(None)}>"),
                     ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], info))
            for values in zip(*batch.columns):
                file.write(page_record(*(v.as_py() for v in values)))
                count += 1
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.array([count], pa.int64())], ["path", "records"]
            )

    with_referred(pages, page_id, url, payload, min_bytes).mapInArrow(run, MANIFEST).write.parquet(
        f"{path}/manifest"
    )
    return manifest(pages.sparkSession, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest")


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Pages as in ``ROW`` of all archives of a manifest, a task for each on average.

    A revisit has no payload of its own; size and digest are those of the full one.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, size = [], 0
                with open_read(path) as file:
                    for data in members(file):
                        row = parse_page(parse_record(data))
                        if row is None:
                            continue
                        held.append(row if payloads else (*row[:2], None, *row[3:]))
                        size += len(data) if payloads else 200
                        if size > 8 << 20:
                            yield made(held)
                            held, size = [], 0
                if held:
                    yield made(held)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    spread = archives.select("path").repartition(max(1, archives.count()))
    return spread.mapInArrow(run, ROW)
