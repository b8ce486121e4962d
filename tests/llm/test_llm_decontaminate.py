import random

from citeflow.llm import decontaminate as dec


def brute(words, items, window=10):
    hit, found = set(), set()
    for item, seq in items:
        size = min(window, len(seq))
        windows = {tuple(seq[i:i + size]) for i in range(len(seq) - size + 1)} if seq else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i:i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(item)
    return hit, found


def test_automaton_against_brute_force():
    rng = random.Random(1)
    for round_ in range(120):
        letters = [b"a", b"b", b"c", b"d"][: rng.randint(1, 4)]
        draw = lambda n: [rng.choice(letters) for _ in range(n)]
        window = rng.randint(2, 5)
        items = [(str(k), draw(rng.randint(0, 12))) for k in range(rng.randint(0, 6))]
        automaton = dec.ItemAutomaton(items, window)
        for _ in range(6):
            words = draw(rng.randint(0, 40)) + [b"x"] * rng.randint(0, 2) + draw(rng.randint(0, 9))
            hit, found = automaton.matches(words)
            assert (set(hit.nonzero()[0].tolist()), found) == brute(words, items, window), (items, words)


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id BIGINT, text STRING, spans STRING")


ITEMS = [
    (1, "a b c d e f g h i j k l", "x"), (1, "a b c d e f g h i j k l", "x"), (2, "Short one!", "y"),
    (3, None, "z"), (4, "", None), (None, "c d e f g h i j k l m n", None),
]


def test_report_and_blocks(spark):
    docs = spark.createDataFrame([
        (1, "zz A, b c d e f g h i j k l m n yy short ONE."), (2, "nothing here"), (3, None), (4, ""),
        (None, "short one"), (2, "short one short one"),
    ], "doc_id BIGINT, text STRING")
    items = items_table(spark, ITEMS)
    one = sorted(map(tuple, dec.report(docs, items).collect()), key=repr)
    many = sorted(map(tuple, dec.report(docs, items, block_words=8).collect()), key=repr)
    assert one == many
    by = {(r[0], r[1]): r for r in one}
    assert by[(1, 18)][2:4] == (16, 3) and by[(1, 18)][5]
    assert by[(2, 2)][2:4] == (0, 0) and not by[(2, 2)][5]
    assert by[(2, 4)][2:4] == (4, 1) and by[(None, 2)][2] == 2
    assert by[(3, 0)][2] == by[(4, 0)][2] == 0


def test_long_items_lose_no_window(spark, monkeypatch):
    monkeypatch.setattr(dec, "CHUNK_WORDS", 12)
    words = [f"w{k}" for k in range(60)]
    items = items_table(spark, [(1, " ".join(words), "")])
    docs = spark.createDataFrame([(k, " ".join(words[k:k + 10])) for k in range(51)], "doc_id BIGINT, text STRING")
    chunks = dec._chunks(items, "item_id", "text").collect()
    automaton = dec.ItemAutomaton([(r.item, bytes(r.words).split()) for r in chunks])
    assert all(automaton.matches(r.text.encode().split())[0].all() for r in docs.collect())


def test_cleaned(spark, odd_docs, no_docs):
    passage = "a b c d e f g h i j"
    docs = spark.createDataFrame([
        (1, f"Keep this, all of it and some more words here: {passage}! And this as well, please.", 9),
        (2, passage, 9), (3, "É clean", 9), (4, None, 9),
        (5, "p q r s t u v w x y z a b c d a b c d e f g h i j e f g h i j end", 9),
    ], "doc_id BIGINT, text STRING, n_chars INT")
    got = {r.doc_id: r for r in dec.cleaned(docs, items_table(spark, ITEMS), max_coverage=0.9).collect()}
    assert set(got) == {1, 3, 4, 5}
    assert got[1].text == "Keep this, all of it and some more words here: ! And this as well, please."
    assert got[1].n_chars == len(got[1].text) and got[3].n_chars == 9 and got[4].text is None
    assert got[5].text == "p q r s t u v w x y z  end"
    same = dec.cleaned(odd_docs, items_table(spark, ITEMS))
    assert same.columns == odd_docs.columns and sorted(map(repr, same.collect())) == sorted(map(repr, odd_docs.collect()))
    assert dec.cleaned(no_docs, items_table(spark, [])).count() == 0
    assert dec.report(no_docs, items_table(spark, ITEMS)).count() == 0


def test_cleaned_is_the_same_in_any_blocks(spark):
    w = [f"w{k}" for k in range(1, 61)]
    items = items_table(spark, [
        (1, " ".join(w[:15]), ""), (2, " ".join(w[5:24]), ""), (3, " ".join(w[30:42]), ""),
        (4, " ".join(w[44:50] + w[55:60]), ""), (5, " ".join(w[48:56]), ""),
    ])
    other = [f"x{k}" for k in range(16)]
    docs = spark.createDataFrame([
        (1, " ".join(w[:24] + other)),  # 24 of 40 words: dropped
        (2, " ".join(w[:24] + other * 3)), (3, " ".join(other)), (4, None),
        (5, " ".join(other * 3 + w[30:36] + w[:24] + w[36:42] + ["end"])),  # a cut closes a gap
        (6, " ".join(other * 4 + w[44:48] + w[48:56] + w[48:50] + w[55:60])),
    ], "doc_id BIGINT, text STRING")
    whole, many = (
        sorted(map(tuple, dec.cleaned(docs, items, block_words=n).collect()))
        for n in (dec.BLOCK_WORDS, 8)
    )
    assert whole == many
    by = dict(whole)
    assert 1 not in by and by[2].split() == other * 3 and by[5].split() == [*other * 3, "end"]
    assert by[3].split() == other and by[4] is None
