"""Random mixed content through the title, abstract and name rules, against a small reader on
the standard library's XML tree."""

import random
import xml.etree.ElementTree as ET
from xml.sax.saxutils import escape, quoteattr

from citeflow.operators.documents import documents
from citeflow.sources.records import read_records, relative_to
from tests.samples import article, write_file

TEXTS = ["", " ", "\n  ", "a", "b c", " lead", "trail ", "<", "&", ">", "é ü", "α", "x > y", '"', "  "]
TAGS = ["i", "b", "sup", "mml:x", "Label"]


def mixed(rng, depth=0):
    out = [escape(rng.choice(TEXTS))]
    for _ in range(rng.choice([0, 0, 1, 2, 3])):
        tag = rng.choice(TAGS)
        attr = rng.choice(["", "", " id='1'", ' c="a > b"'])
        if depth < 2 and rng.random() < 0.8:
            out.append(f"<{tag}{attr}>{mixed(rng, depth + 1)}</{tag}>")
        else:
            out.append(f"<{tag}{attr}/>")
        out.append(escape(rng.choice(TEXTS)))
    return "".join(out)


def make(rng, pmid):
    parts = []
    for _ in range(rng.randrange(4)):
        label = rng.choice(["", "", ' Label=""', f" Label={quoteattr(rng.choice(['AIM', 'A > B', 'x & y']))}"])
        parts.append(f"<AbstractText{label}>{mixed(rng)}</AbstractText>")
    gap = rng.choice(["", "\n", " "])
    return article(
        pmid,
        title=rng.choice(["", f"<ArticleTitle>{mixed(rng)}</ArticleTitle>"])
        + rng.choice(["", f"<BookTitle book='1'>{mixed(rng)}</BookTitle>"]),
        abstract=f"<Abstract>{gap.join(parts)}</Abstract>" if parts else "",
        headings=f'<MeshHeadingList><MeshHeading><DescriptorName UI="D1">{mixed(rng)}'
                 "</DescriptorName></MeshHeading></MeshHeadingList>",
    )


def nodes(element):
    texts = [element.text, *(child.tail for child in element)]
    return [t for t in texts if t]


def expected(xml):
    root = ET.fromstring(xml.replace("mml:", "mml"))
    art = root.find("MedlineCitation/Article")
    title = ""
    for path in ("ArticleTitle", "BookTitle"):
        found = [n for e in art.findall(path) for n in nodes(e)]
        if found:
            title = found[0]
            break
    abstract, html = "", ""
    for part in art.findall("Abstract/AbstractText"):
        label = part.get("Label")
        abstract += (f"{label}: " if label else "") + "".join(nodes(part)) + "\n"
        if part.text:
            html += (f"<b>{label}</b>: " if label else "") + part.text + "<br>"
    name = root.find("MedlineCitation/MeshHeadingList/MeshHeading/DescriptorName").text or None
    return title, abstract.rstrip(), html, name


def test_mixed_content(spark, tmp_path):
    rng = random.Random(11)
    xml = {str(i): make(rng, i) for i in range(1500)}
    write_file(tmp_path, "baseline/f.xml.gz", *xml.values())
    records = read_records(spark, str(tmp_path), relative_to(str(tmp_path)))
    docs = documents(records, ("title", "abstract", "abstract_html", "mesh_all"))
    got = {r.pmid: (r.title, r.abstract, r.abstract_html, r.mesh_all[0].name) for r in docs.collect()}
    assert len(got) == len(xml)
    wrong = {p: (got[p], expected(x)) for p, x in xml.items() if got[p] != expected(x)}
    assert not wrong, next(iter(wrong.items()))
