import re

import pytest

from citeflow.llm import license_scan as lic

PHRASES = [("mit", ["mit", "license"]), ("apache", ["apache", "license"]), ("gpl", ["general", "public", "license"])]


def brute(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(i, label) for label, p in PHRASES for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


NOTICE = lic.NOTICES[0].text
CASES = [
    "MIT License", "mit-license, GENERAL public\nlicense the Apache  License", None, "", "K mit İ license",
    "mit mit license license", "general public general public license", "mıt license", "MITé license",
    "mit license " * 3000, "x", NOTICE.upper(), NOTICE.replace("any person", "any other nice person"),
    NOTICE[:60], "of the terms of the in the",
]


def test_places_against_brute_force(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(CASES)] + [(0, CASES[0]), (None, CASES[1])],
                                 "doc_id BIGINT, text STRING")
    got = lic.scan(docs).collect()
    assert len(got) == len(CASES) + 2
    for r in got:
        text = CASES[1] if r.doc_id is None else CASES[r.doc_id]
        assert tuple(r)[1:6] == brute(text), text
    by = {r.doc_id: r for r in got}
    assert by[11].labels == "mit" and by[11].score == 1 and by[11].base_labels == ""
    assert by[12].labels == "mit" and 0.8 < by[12].score < 1
    assert by[13].labels == "" and by[14].labels == "" and by[2].score == 0


def test_odd_rows(spark, odd_docs, no_docs):
    got = lic.scan(odd_docs)
    assert got.count() == odd_docs.count() and got.where("labels <> '' OR score <> 0").count() == 0
    assert lic.scan(no_docs).count() == 0


def test_templates_are_bounded():
    with pytest.raises(ValueError):
        lic.template_pairs((lic.Template("x", "one"),))
    with pytest.raises(ValueError):
        lic.template_pairs((lic.Template("x", "w " * 30_000),))


def test_plan_is_native(spark, odd_docs):
    plan = lic.scan(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
