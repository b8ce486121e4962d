import base64
import hashlib
import json
import random
import re

from citeflow.llm import secret_scan as sec
from citeflow.llm.queries import QUERIES

PATTERNS = (
    (r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    (r"AKIA[A-Z0-9]+", 0, 16), (r"[0-9a-f]+", 0, 32),
)


def brute(text):
    spans = [(m.start(), k, m.end()) for k, (p, g, n) in enumerate(PATTERNS)
             for m in re.finditer(p, text or "") if len(m[g]) >= n]
    digest = ",".join(f"{sec.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
    return (*(sum(x[1] == k for x in spans) for k in range(3)), hashlib.sha256(digest.encode()).hexdigest())


def test_query_agrees_with_plain_patterns(spark, tables):
    want = {r.doc_id: brute(r.text) for r in tables("documents", "sf0.01").collect()}
    got = QUERIES["op6_secret_scan"](spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: tuple(r)[1:5] for r in got} == want
    assert sum(r.n_assign for r in got) > 5


def test_base_on_random_texts():
    rng = random.Random(2)
    bits = ["token", "Secret", "API_KEY", "apikey", "PASSWORD", "paſſwd", "AKIA", "=", " = ", ": ", "\"", "'", "é", "\n",
            "abcdef0123456789" * 2, "AKIAABCDEFGHIJKL", "short", "longenough1", "toKen", "--", "f" * 31, "f" * 33]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
        spans = [s for s in sec.find(text.encode()) if s[1] < 3]
        digest = hashlib.sha256(sec._joined(spans).encode()).hexdigest()
        assert (*(sum(s[1] == k for s in spans) for k in range(3)), digest) == brute(text), text


def der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x82, size >> 8, size & 255])
    return bytes([tag]) + head + body


def number(size):
    return der(2, b"\x01" * size)


PKCS8 = der(0x30, number(1) + der(0x30, der(6, b"\x2a\x86\x48")) + der(4, b"k" * 48))
PKCS1 = der(0x30, number(1) + number(64) * 8)
SEC1 = der(0x30, number(1) + der(4, b"k" * 64))
OPENSSH = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (
    1).to_bytes(4, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in (b"public", b"private"))


def kinds(text):
    return [(sec.KINDS[k], text[s:e]) for s, k, e in sec.find(text.encode())]


def part(value):
    return base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")


def test_keys_are_confirmed_by_structure():
    for key in (PKCS8, PKCS1, SEC1, OPENSSH):
        assert sec.is_private_key(key) and not sec.is_private_key(key[:-1])
        coded = base64.b64encode(key).decode()
        assert ("key64", coded) in kinds(f"é {coded} end")
        assert all(k != "key64" for k, _ in kinds(f"é {coded[:-8]} end"))
        lines = "\n".join(coded[i:i + 64] for i in range(0, len(coded), 64))
        block = f"-----BEGIN RSA PRIVATE KEY-----\n{lines}\n-----END RSA PRIVATE KEY-----"
        assert ("pem", block) in kinds(f"é {block} x")
        assert all(k != "pem" for k, _ in kinds(block.replace(lines, lines[:-12])))
    assert ("keyhex", PKCS1.hex().upper()) in kinds(f"x={PKCS1.hex().upper()};")
    assert not sec.is_private_key(der(0x30, b"\x05\x00")) and not sec.is_private_key(b"\x30\x80")


def test_signed_tokens_need_their_header():
    good = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': 1})}.sig_-x"
    assert ("jwt", good) in kinds(f"see {good} ok")
    assert kinds(f"see {part({'typ': 'JWT'})}.{part({'sub': 1})}.sig ok") == []
    assert kinds("see eyJabc.eyJdef.x ok") == []


def test_odd_rows(odd_docs, no_docs):
    got = sec.scan(odd_docs)
    empty = hashlib.sha256(b"").hexdigest()
    assert {tuple(r)[1:] for r in got.collect()} == {(0, 0, 0, empty, "")} and got.count() == odd_docs.count()
    assert sec.scan(no_docs).count() == 0
