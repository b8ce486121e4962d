import datetime

import pytest

from citeflow.operators.documents import documents, search_rows
from citeflow.operators.quality import bad_dates, bad_records, missing_ids, missing_titles
from citeflow.sources.records import read_records, relative_to
from tests.samples import article, book, write_file


def scan(spark, folder):
    return read_records(spark, str(folder), relative_to(str(folder)))


def docs_of(spark, tmp_path, *records, fields=None):
    write_file(tmp_path, "baseline/f1.xml.gz", *records)
    found = documents(scan(spark, tmp_path), *([fields] if fields else []))
    return {r.pmid: r for r in found.collect()}


def test_titles(spark, tmp_path):
    cases = {
        "1": ("<ArticleTitle>Effect of <i>E. coli</i> on Y</ArticleTitle>", "Effect of "),
        "2": ("<ArticleTitle><i>All</i> tail</ArticleTitle>", " tail"),
        "3": ("<ArticleTitle><b>only</b></ArticleTitle>", ""),
        "4": ("", ""),
        "5": ("<ArticleTitle> <i>A</i> tail</ArticleTitle>", " "),
        "6": ("<ArticleTitle/><BookTitle>Book</BookTitle>", "Book"),
        "7": ("<ArticleTitle>a &amp; b &lt;c&gt; é</ArticleTitle>", "a & b <c> é"),
        "8": ("<ArticleTitle>x<![CDATA[<y> ]]>z</ArticleTitle>", "x<y> z"),
        "9": ("<ArticleTitle><i>a</i> <b>b</b></ArticleTitle>", " "),
        "10": ("<ArticleTitle><i>a</i><b>b</b>tail</ArticleTitle>", "tail"),
        "11": ("<ArticleTitle><!-- c --><b><i>x</i></b>tail &gt; <i>x</i></ArticleTitle>", "tail > "),
    }
    docs = docs_of(spark, tmp_path, *(article(p, title=t) for p, (t, _) in cases.items()))
    assert {p: d.title for p, d in docs.items()} == {p: want for p, (_, want) in cases.items()}
    missing = {r.pmid for r in missing_titles(scan(spark, tmp_path)).collect()}
    assert missing == {"3", "4"}


def test_abstracts(spark, tmp_path):
    def parts(*xml):
        return f"<Abstract>\n{''.join(xml)}</Abstract>"

    cases = {
        "1": (parts('<AbstractText Label="AIM">We <b>bold</b> tail.</AbstractText>',
                    "<AbstractText>Two</AbstractText>"), "AIM: We  tail.\nTwo"),
        "2": (parts('<AbstractText Label="">One</AbstractText>', "<AbstractText/>",
                    "<AbstractText>Three</AbstractText>"), "One\n\nThree"),
        "3": (parts("<AbstractText>a <i>A</i> <b>B</b> c</AbstractText>"), "a   c"),
        "4": (parts("<AbstractText>end   \n </AbstractText>"), "end"),
        "5": ("", ""),
        "6": (parts('<AbstractText Label="A &gt; B">x</AbstractText>'), "A > B: x"),
        "7": (parts("<AbstractText>a<!-- note -->b</AbstractText>"), "ab"),
    }
    docs = docs_of(spark, tmp_path, *(article(p, abstract=a) for p, (a, _) in cases.items()))
    assert {p: d.abstract for p, d in docs.items()} == {p: want for p, (_, want) in cases.items()}


def test_authors_types_journal(spark, tmp_path):
    authors = """<AuthorList>
      <Author><LastName>Doe</LastName><ForeName>Jane</ForeName><Initials>J</Initials></Author>
      <Author><LastName>Roe</LastName><Initials>R</Initials></Author>
      <Author><CollectiveName>Group</CollectiveName></Author>
      <Author><LastName>Doe</LastName></Author>
    </AuthorList>"""
    types = """<PublicationTypeList>
      <PublicationType UI="D1">Journal Article</PublicationType>
      <PublicationType><i>x</i>tail</PublicationType><PublicationType/>
    </PublicationTypeList>"""
    journal = "<Title>J of X</Title><ISOAbbreviation>J X</ISOAbbreviation>"
    docs = docs_of(
        spark, tmp_path, article("1", authors=authors, types=types, journal=journal), article("2")
    )
    assert docs["1"].authors == ["Doe, Jane", "Roe, R", ", ", "Doe, "]
    assert docs["1"].article_types == ["Journal Article", None, None]
    assert (docs["1"].journal_title, docs["1"].journal_iso_title) == ("J of X", "J X")
    assert (docs["2"].authors, docs["2"].article_types, docs["2"].journal_title) == ([], [], "")


def test_doi(spark, tmp_path):
    def own(doi):
        return (f'<ArticleIdList><ArticleId IdType="pubmed">1</ArticleId>'
                f'<ArticleId IdType="doi">{doi}</ArticleId></ArticleIdList>')

    def cited(*inner):
        return f"<ReferenceList>{''.join(inner)}</ReferenceList>"

    def ref(doi=None):
        ids = f'<ArticleIdList><ArticleId IdType="doi">{doi}</ArticleId></ArticleIdList>'
        return f"<Reference><Citation>c</Citation>{ids if doi else ''}</Reference>"

    docs = docs_of(
        spark, tmp_path,
        article("1", data=own("10.1/a") + cited(ref("10.9/r"))),
        article("2", data=cited(ref(), ref("10.9/r"), ref("10.9/s"))),
        article("3"),
        article("4", data=own("") + cited(cited(ref("10.9/n")))),
        article("5", data=cited(ref()) + cited(ref("10.9/second"))),
    )
    assert {p: d.doi for p, d in docs.items()} == {
        "1": "10.1/a", "2": "10.9/r", "3": None, "4": "10.9/n", "5": "10.9/second",
    }


def test_full_title(spark, tmp_path):
    records = [
        article("1", "<ArticleTitle>Effect of <i>E. coli</i> on <sup>2</sup>Y</ArticleTitle>"),
        article("2", "<ArticleTitle>  <b>both</b>  blanks </ArticleTitle>"),
        article("3", "<ArticleTitle/><BookTitle>Book <i>in</i> article</BookTitle>"),
        article("4", ""),
        article("5", "<ArticleTitle>a &amp; b<![CDATA[<c>]]></ArticleTitle>"),
        book("6", "<BookTitle>The <i>book</i></BookTitle>"),
    ]
    docs = docs_of(spark, tmp_path, *records, fields=("full_title",))
    assert {p: d.full_title for p, d in docs.items()} == {
        "1": "Effect of E. coli on 2Y", "2": "  both  blanks ", "3": "Book in article", "4": "",
        "5": "a & b<c>", "6": "The book",
    }


def test_doi_at_any_depth(spark, tmp_path):
    def nested(depth, doi):
        ids = f'<Reference><ArticleIdList><ArticleId IdType="doi">{doi}</ArticleId></ArticleIdList></Reference>'
        return "<ReferenceList>" * depth + ids + "</ReferenceList>" * depth

    records = [article(str(d), data=nested(d, f"10.5/depth{d}")) for d in range(1, 6)]
    records.append(article("9", data=nested(4, "") + nested(5, "10.5/later")))
    records.append(article("8", data=nested(3, " ") + "<ArticleId>doi</ArticleId>"))
    docs = docs_of(spark, tmp_path, *records, "<PubmedArticle><Broken", fields=("doi",))
    assert {p: d.doi for p, d in docs.items() if p} == {
        **{str(d): f"10.5/depth{d}" for d in range(1, 6)}, "9": "10.5/later", "8": None,
    }


def test_compounds_and_mesh(spark, tmp_path):
    chemicals = """<ChemicalList>
      <Chemical><NameOfSubstance UI="D1">one</NameOfSubstance></Chemical>
      <Chemical><NameOfSubstance>none</NameOfSubstance></Chemical>
    </ChemicalList>"""
    headings = """<MeshHeadingList>
      <MeshHeading><DescriptorName UI="D1">one</DescriptorName></MeshHeading>
      <MeshHeading><DescriptorName UI="D2"><i>x</i>two</DescriptorName></MeshHeading>
    </MeshHeadingList>"""
    fields = ("compounds", "mesh", "mesh_all")
    docs = docs_of(
        spark, tmp_path, article("1", chemicals=chemicals, headings=headings), article("2"),
        fields=fields,
    )
    d = docs["1"]
    assert [tuple(c) for c in d.compounds] == [("MESH:D1", "one"), ("MESH:None", "none")]
    assert [tuple(m) for m in d.mesh] == [("MESH:D2", None)]
    assert [tuple(m) for m in d.mesh_all] == [("MESH:D1", "one"), ("MESH:D2", None)]
    assert (docs["2"].compounds, docs["2"].mesh) == ([], [])


DATES = [
    # year, month, day, free text, wanted, bad
    ("2019", "Feb", "1", None, "2019-02-01", False),
    ("2019", "FEB", "01", None, "2019-02-01", False),
    ("2019", None, None, None, "2019-01-01", False),
    ("2019", "3", "5", None, "2019-3-5", False),
    ("2019", "03", None, None, "2019-03-01", False),
    ("2019", "Feb", "30", None, "1900-01-01", True),
    ("2019", "February", "01", None, "1900-01-01", True),
    ("2019", "an ", "01", None, "1900-01-01", True),
    ("2019", "ebm", "01", None, "1900-01-01", True),
    ("2019", "dEc", "9", None, "2019-12-09", False),
    ("2020", "Feb", "29", None, "2020-02-29", False),
    ("2019", "Feb", "29", None, "1900-01-01", True),
    ("219", "Feb", "01", None, "1900-01-01", True),
    ("2019", "Sept", "01", None, "1900-01-01", True),
    ("2019", "Feb", "001", None, "1900-01-01", True),
    ("0000", "Feb", "01", None, "1900-01-01", True),
    ("12019", "Feb", "01", None, "1900-01-01", True),
    ("1850", "Jan", "01", None, "1850-01-01", False),
    (None, None, None, None, "1900-01-01", False),
    (None, None, None, "1998 Dec-1999 Jan", "1998-01-01", False),
    (None, None, None, "Spring 1850", "1900-01-01", False),
    (None, None, None, "Spring", "1900-01-01", False),
    (None, None, None, "Spring 20011", "2001-01-01", False),
]


def date_xml(year, month, day, medline):
    names = ("Year", "Month", "Day", "MedlineDate")
    values = (year, month, day, medline)
    return "".join(f"<{n}>{v}</{n}>" for n, v in zip(names, values) if v is not None)


def test_dates(spark, tmp_path):
    records = [article(str(i), date=date_xml(*case[:4])) for i, case in enumerate(DATES)]
    docs = docs_of(spark, tmp_path, *records)
    assert {i: docs[str(i)].pub_date for i in range(len(DATES))} == {
        i: case[4] for i, case in enumerate(DATES)
    }
    bad = {int(r.pmid) for r in bad_dates(scan(spark, tmp_path)).collect()}
    assert bad == {i for i, case in enumerate(DATES) if case[5]}


def test_books(spark, tmp_path):
    authors = "<AuthorList><Author><LastName>{}</LastName></Author></AuthorList>"
    docs = docs_of(
        spark, tmp_path,
        book("1", title="<BookTitle>Big <i>x</i></BookTitle>",
             date="<Year>2010</Year><Month>Mar</Month>", book_authors=authors.format("Ed"),
             authors=authors.format("Au"),
             abstract='<Abstract><AbstractText Label="L">t</AbstractText></Abstract>'),
        article("2"),
        book("3", title=""),
        article("4"),
    )
    b = docs["1"]
    assert (b.title, b.pub_date, b.abstract) == ("Big ", "2010-03-01", "L: t")
    assert b.authors == ["Ed, ", "Au, "]
    assert (b.doi, b.journal_title, b.article_types, b.mesh) == ("", "", [], [])
    assert set(docs) == {"1", "2", "4"}
    assert docs["1"].source_file == "baseline/f1.xml.gz"


def test_bad_records_do_not_stop_the_rest(spark, tmp_path):
    broken = article("2").replace("</Article>", "")
    no_article = "<PubmedArticle><MedlineCitation><PMID>5</PMID></MedlineCitation></PubmedArticle>"
    docs = docs_of(
        spark, tmp_path, article("1"), broken, article("3"), article(None), no_article,
        book("6", title=""), "<PubmedArticle/>", article("7", title=titled_entity()),
    )
    assert set(docs) == {"1", "3"}
    bad = [(r.kind, r.error) for r in bad_records(scan(spark, tmp_path)).collect()]
    assert sorted(bad) == sorted([
        ("PubmedArticle", "malformed xml"), ("PubmedArticle", "malformed xml"),
        ("PubmedArticle", "no record id"), ("PubmedArticle", "no record id"),
        ("PubmedArticle", "no article"), ("PubmedBookArticle", "no book title"),
    ])
    assert missing_ids(scan(spark, tmp_path)).count() == 2


def titled_entity():
    return "<ArticleTitle>a&nbsp;b</ArticleTitle>"


def test_search_rows(spark, tmp_path):
    abstract = ('<Abstract><AbstractText Label="AIM">We <b>x</b> y</AbstractText>'
                "<AbstractText><i>x</i>tail</AbstractText><AbstractText>Z</AbstractText></Abstract>")
    created = "<DateCreated><Year>2001</Year><Month>2</Month><Day>03</Day></DateCreated>"
    write_file(
        tmp_path, "baseline/f.xml.gz",
        article("1", abstract=abstract, created=created, title="<ArticleTitle>A<i>b</i></ArticleTitle>"),
        article("2", title="<ArticleTitle><i>b</i>c</ArticleTitle>"), book("3"),
    )
    rows = {r.pmid: r.source for r in search_rows(scan(spark, tmp_path)).collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"].abstract == "<b>AIM</b>: We <br>Z<br>"
    assert rows["1"].created_date == datetime.date(2001, 2, 3)
    assert (rows["1"].title, rows["2"].title, rows["2"].created_date) == ("A", None, None)


@pytest.mark.parametrize("fields", [("title",), ("pub_date", "mesh"), ()])
def test_narrow_parse_agrees_with_full(spark, tmp_path, fields):
    records = [article("1", date=date_xml("2019", "Feb", "1", None)), book("2"), article(None)]
    full = docs_of(spark, tmp_path, *records)
    narrow = {r.pmid: r for r in documents(scan(spark, tmp_path), fields).collect()}
    assert set(full) == set(narrow) == {"1", "2"}
    for name in fields:
        assert {p: d[name] for p, d in full.items()} == {p: d[name] for p, d in narrow.items()}
