"""Secrets in texts: candidates by pattern, reported once their structure is confirmed.

Three plain kinds (``assign``, ``access``, ``hex``) are patterns with a least length. The others
are decoded first: ``jwt`` needs a header and a claim set that are JSON objects and an algorithm;
``pem`` a private-key block whose body decodes to a key; ``key64`` and ``keyhex`` are base64 and hex
runs that decode to a private key. A key is a DER structure whose nested lengths fill it to the
last byte (PKCS#1, PKCS#8 or SEC 1) or the OpenSSH format. Texts are asked for literal marks of a
kind before its pattern runs.

Defined results: a null or empty text has no spans; repeated rows are scanned each; places are code
points, ends exclusive; spans are ordered by start, then kind in the order above, then end.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "jwt", "pem", "key64", "keyhex")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]*")
_PEM = re.compile(
    r"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY-----([A-Za-z0-9+/=\s:,.-]*?)-----END \1PRIVATE KEY-----"
)
# A DER sequence begins with the byte 0x30, OpenSSH keys with "openssh-key-v1".
_KEY64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-P]|b3BlbnNzaC1rZXk)[A-Za-z0-9+/_-]{40,}={0,2}")
_KEYHEX = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{80,}")

_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_MARKS = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_RUN64 = bytes(120 if chr(b) in
               "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-" else 32
               for b in range(256))
_MAGIC = b"openssh-key-v1\0"


def decode64(text: str) -> bytes | None:
    """Plain or URL-safe base64, padded or not."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_values(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of the values that fill ``data`` exactly, or None."""
    values, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            count = size & 0x7F
            if not 1 <= count <= 4 or at + count > len(data):
                return None
            size = int.from_bytes(data[at:at + count], "big")
            at += count
        if at + size > len(data):
            return None
        values.append((tag, data[at:at + size]))
        at += size
    return values


def is_private_key(data: bytes | None) -> bool:
    """PKCS#1, PKCS#8 or SEC 1 with consistent nested lengths, or the OpenSSH format."""
    if not data:
        return False
    if data.startswith(_MAGIC):
        return _is_openssh(data[len(_MAGIC):])
    outer = der_values(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = der_values(outer[0][1])
    if not inner or inner[0][0] != 0x02 or len(inner[0][1]) != 1:
        return False
    tags = [tag for tag, _ in inner]
    if tags[1:3] == [0x30, 0x04]:  # version, algorithm, key
        algorithm = der_values(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06
    if len(tags) >= 9 and set(tags[:9]) == {0x02}:  # version and the eight numbers of RSA
        return True
    return tags[1:2] == [0x04] and len(inner[1][1]) >= 16  # elliptic curve


def _is_openssh(data: bytes) -> bool:
    """Cipher, key derivation, its options, then as many public keys as it says."""
    def text(at: int) -> tuple[bytes | None, int]:
        end = at + 4 + int.from_bytes(data[at:at + 4], "big")
        return (data[at + 4:end], end) if at + 4 <= len(data) and end <= len(data) else (None, at)

    at = 0
    for _ in range(3):
        value, at = text(at)
        if value is None:
            return False
    count, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    if not 1 <= count <= 16:
        return False
    for _ in range(count + 1):
        value, at = text(at)
        if not value:
            return False
    return True


def is_signed_token(header: str, claims: str) -> bool:
    try:
        head, body = (json.loads(decode64(part) or b"") for part in (header, claims))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def find(raw: bytes | None) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of all spans, ordered; ``kind`` counts in ``KINDS``."""
    raw = raw or b""
    low = raw.lower()
    wanted = set()
    if any(w in low for w in _WORDS):
        wanted.add("assign")
    if b"AKIA" in raw:
        wanted.add("access")
    if b"x" * 32 in raw.translate(_HEX_MARKS):
        wanted.add("hex")
    if b"eyJ" in raw:
        wanted.add("jwt")
    if b"PRIVATE KEY-----" in raw:
        wanted.add("pem")
    if b"x" * 42 in raw.translate(_RUN64):
        wanted.update(("key64", "keyhex"))
    if not wanted:
        return []
    text, spans = raw.decode("utf-8", "replace"), []

    def add(kind: str, found) -> None:
        spans.extend((m.start(), KINDS.index(kind), m.end()) for m in found)

    if "assign" in wanted:
        add("assign", (m for m in _ASSIGN.finditer(text) if len(m[2]) >= 8))
    if "access" in wanted:
        add("access", (m for m in _ACCESS.finditer(text) if len(m[0]) >= 16))
    if "hex" in wanted:
        add("hex", (m for m in _HEX.finditer(text) if len(m[0]) >= 32))
    if "jwt" in wanted:
        add("jwt", (m for m in _JWT.finditer(text) if is_signed_token(m[1], m[2])))
    if "pem" in wanted:
        add("pem", (m for m in _PEM.finditer(text) if _is_pem(m[2])))
    if "key64" in wanted:
        add("key64", (m for m in _KEY64.finditer(text) if is_private_key(decode64(m[0]))))
        add("keyhex", (m for m in _KEYHEX.finditer(text)
                       if len(m[0]) % 2 == 0 and is_private_key(bytes.fromhex(m[0]))))
    return sorted(spans)


def _is_pem(body: str) -> bool:
    """Headers such as those of an encrypted key end with an empty line; the rest is the key."""
    head, blank, rest = body.replace("\r", "").strip().partition("\n\n")
    if blank and ":" in head:  # encrypted: the body is a cipher text of whole blocks
        data = decode64("".join(rest.split()))
        return bool(data) and len(data) % 8 == 0
    return is_private_key(decode64("".join(body.split())))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, counts of the plain kinds, a digest of their spans, and all spans, for each row."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("body"))
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType),
        *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:3]),
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for body in batch.column(1):
                spans = find(body.as_py())
                base = [s for s in spans if s[1] < 3]
                counts = [sum(s[1] == k for s in base) for k in range(3)]
                made.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            columns = list(zip(*made)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=schema.names
            )

    return rows.mapInArrow(run, schema)
