import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from citeflow.llm import token_files
from citeflow.llm.queries import QUERIES, TOKENIZER
from citeflow.plans.workspace import new_dir


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))  # untouched, as the contract calls it
    return lambda text: found.encode(text, add_special_tokens=False).ids


def want(rows, plain):
    """Ids ascending (null first), rows of an id in any order."""
    return [(k, [*plain(t or ""), 2]) for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]


def test_pieces_give_the_ids_of_whole_texts(plain):
    coder = token_files.Encoder(TOKENIZER)
    rng = random.Random(3)
    marks = ["a", "Word", "'s", "'", "42", "é", "ß", "日本", " ", "  ", "\n", "\n\n", "\t", "\r\n", "!", "?!", ",", "...", "+", " ", " ",
             "\u2003", "\u200b", "\x1c", "\x85", "\u3000", "<|endoftext|>", "\U0001f600", "\x00", "\u0301", "_", "\ufeff"]
    for _ in range(3000):
        text = "".join(rng.choice(marks) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(coder.encode(text), coder.dtype).tolist() == plain(text), repr(text)


def test_names_of_added_tokens(plain):
    coder = token_files.Encoder(TOKENIZER)
    for text in ("end <|endoftext|> of", "<|endoftext|>", "a  <|endoftext|>\n b"):
        assert np.frombuffer(coder.encode(text), coder.dtype).tolist() == plain(text)
    assert 50256 in plain("end <|endoftext|> of")


def test_cache_may_be_emptied(plain, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_PIECES", 4)
    coder = token_files.Encoder(TOKENIZER)
    for text in ("one, two, three one,", "one two three four five", "two one", "a b c d", "x" * 100 + " y", "x" * 100):
        assert np.frombuffer(coder.encode(text), coder.dtype).tolist() == plain(text)


def test_query_agrees_with_the_tokenizer(spark, tables, plain):
    at, expected = 0, []
    for k, ids in want([(r.doc_id, r.text) for r in tables("documents").collect()], plain):
        expected.append((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = QUERIES["op1_token_files"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect())) == expected


def test_odd_rows_round_trip(spark, odd_docs, no_docs, plain):
    shards = token_files.write(odd_docs, new_dir(spark, "t"), TOKENIZER)
    got = sorted(token_files.read_tokens(shards).collect(), key=lambda r: r.start)
    rows = want([(r.doc_id, r.text) for r in odd_docs.collect()], plain)
    assert sorted(((r.doc_id, r.tokens) for r in got), key=repr) == sorted(rows, key=repr)
    assert [r.doc_id for r in got] == [k for k, _ in rows]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    empty = token_files.write(no_docs, new_dir(spark, "t"), TOKENIZER)
    assert token_files.read_checksums(empty).count() == 0


def test_groups_of_texts_encode_as_the_library_does():
    """Words of a group are given to the library in few texts, and no id changes by it."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = token_files.Encoder(path)
    texts = [
        None, "", " ", "a", " a", "a ", "one two, two. it's don't", "x  y", "x\ny z\n", "Ġ Ġx é日本 🙂",
        "tab\there", "a b c", "\r\nq w", "<|endoftext|> end", " ".join(f"word{i}" for i in range(300)),
    ]
    given = []
    encode = coder._encode

    def counted(pieces):
        given.extend(pieces)
        return encode(pieces)

    coder._encode = counted
    found = list(coder.encode_all(pa.array(texts)))
    for text, ids in zip(texts, found):
        whole = coder.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, coder.dtype).tolist() == whole
    assert len(given) < 100


def test_words_around_line_ends_are_learned_apart(plain, monkeypatch):
    """Every line gives another pair of words; each word is given to the library once, not each pair."""
    monkeypatch.setattr(token_files, "CACHED_PIECES", 200)
    coder = token_files.Encoder(TOKENIZER)
    rng = random.Random(11)
    words = ["one", "Two.", "x'", "é,", "日本", "+", "don't", "4", *(f"w{i}" for i in range(30))]
    texts = ["\n".join(f"{rng.choice(words)} {rng.choice(words)}" for _ in range(50)) for _ in range(20)]
    texts += ["a\n\nb c\n\n\nd", "\nq w\n", "a " + "y" * 60 + "\n" + "z" * 60, None, "Ġ\nĠx y\n'"]
    given = []
    encode = coder._encode
    coder._encode = lambda pieces: given.extend(pieces) or encode(pieces)
    for text, ids in zip(texts, coder.encode_all(pa.array(texts))):
        assert np.frombuffer(ids, coder.dtype).tolist() == plain(text or "")
    assert len(given) < 100  # heads, marks and the odd ones
