"""Record files rendered from the given tables, so that the queries have files to scan.

Every row of a table becomes a record. Rows are spread over files by a sum of several columns,
and the number of files follows the row count, so no file grows with a frequent key. A corpus is
written once per session and table folder.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.plans.workspace import new_dir
from citeflow.schema import ARTICLE
from citeflow.sources.records import phase_of, read_chunks, split_records


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_count(rows: DataFrame, rows_per_file: int) -> int:
    """Files for a table: the row count comes from the Parquet footers."""
    return max(1, rows.count() // rows_per_file)


def folder_name(path: Column) -> Column:
    """File name of a rendered file, which Spark keeps in its partition folders."""
    below = F.substring_index(path, "/folder=", -1)
    folder, file = F.substring_index(below, "/file=", 1), F.substring_index(below, "/file=", -1)
    return F.concat(folder, F.lit("/"), F.substring_index(file, "/", 1), F.lit(".xml.gz"))


class Placed(NamedTuple):
    """Rows with their folder and file, the columns that order a file, and the SQL expression of
    a row's xml. The rows travel to their files as they are and are rendered there: the text is
    several times larger than the columns it is made of."""

    rows: DataFrame
    order: tuple[str, ...]
    xml: str


# How a record file begins and ends when it has a root element.
_HEAD = '<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE PubmedArticleSet>\n<PubmedArticleSet>'
_TAIL = "</PubmedArticleSet>"


def _write(placed: Placed, path: str, root: bool = False) -> None:
    rows, order, xml = placed.rows, placed.order, placed.xml
    if root:
        ends = rows.select("folder", "file").distinct().withColumn("_part", F.explode(F.array(F.lit(0), F.lit(2))))
        rows = rows.withColumn("_part", F.lit(1)).unionByName(ends, allowMissingColumns=True)
        order = ("_part", *order)
        xml = f"CASE _part WHEN 0 THEN '{_HEAD}' WHEN 2 THEN '{_TAIL}' ELSE {xml} END"
    ordered = rows.repartition("folder", "file").sortWithinPartitions("folder", "file", *order)
    files = ordered.selectExpr("folder", "file", f"{xml} AS xml").write.partitionBy("folder", "file")
    # Read once or twice and thrown away: the level that costs least time.
    files.options(compression="gzip", **{"zlib.compress.level": "BEST_SPEED"}).text(path)


def with_root(spark: SparkSession, sf_dir: str, render: Renderer) -> str:
    """A new folder with the corpus written whole, each file in a root element."""
    path = new_dir(spark, f"{render.__name__}-rooted")
    _write(render(spark, sf_dir), path, root=True)
    return path


def _shard(prefix: str, key: str, files: int) -> str:
    return f"concat('{prefix}', lpad(cast(({key}) % {files} as string), 6, '0'))"


def _el(tag: str, body: str) -> str:
    return f"'<{tag}>', {body}, '</{tag}>'"


def _id(key: str) -> str:
    return f"'<PMID Version=\"1\">', {key}, '</PMID>\\n'"


# Illegal in XML 1.0, and line ends as an XML reader gives them.
_CLEAN = (
    r"regexp_replace(regexp_replace(text, '\r\n?', '\n'), "
    r"'[\u0000-\u0008\u000B\u000C\u000E-\u001F\uFFFE\uFFFF]', '')"
)
_ESCAPED = f"replace(replace(replace({_CLEAN}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def texts(spark: SparkSession, sf_dir: str) -> Placed:
    """``documents``: whole texts as abstracts, one part per line.

    Every third part has a label, every second one an inline tag. Of each 40 documents one has
    no title and one only a book title; of each 45 one has no id; of each 50 one is malformed.
    """
    docs = table(spark, sf_dir, "documents")
    part = (
        "concat('<AbstractText', if((i + 1) % 3 = 0, concat(' Label=\"PART ', i + 1, '\"'), ''), "
        "'>', line, if((i + 1) % 2 = 0, '<sup>2</sup> end', ''), '</AbstractText>\\n')"
    )
    title = (
        "CASE doc_id % 40 WHEN 0 THEN '' "
        "WHEN 20 THEN concat('<ArticleTitle><b>no</b></ArticleTitle>', "
        "'<BookTitle>Book of ', lang, '</BookTitle>') "
        "ELSE concat('<ArticleTitle>', regexp_extract(lines[0], '^[^ ]* ?', 0), '<i>', "
        "regexp_replace(lines[0], '^[^ ]* ?', ''), '</i> in ', lang, '</ArticleTitle>') END"
    )
    xml = f"""concat('<PubmedArticle>\\n<MedlineCitation>\\n',
        if(doc_id % 45 = 7, '', concat({_id('doc_id')})),
        '<DateCreated>', {_el('Year', '2000 + doc_id % 20')}, {_el('Month', 'doc_id % 12 + 1')},
        {_el('Day', 'doc_id % 31 + 1')}, '</DateCreated>\\n<Article>\\n', {title},
        '\\n<Abstract>\\n', array_join(transform(lines, (line, i) -> {part}), ''), '</Abstract>\\n',
        '<PublicationTypeList>\\n<PublicationType UI="L">', lang, '</PublicationType>\\n',
        '<PublicationType>', if(doc_id % 7 = 0, '<i>from</i>', ''), source, '</PublicationType>\\n',
        '</PublicationTypeList>\\n</Article>\\n', if(doc_id % 50 = 49, '<Open>', ''),
        '</MedlineCitation>\\n</PubmedArticle>')"""
    file = _shard("art-", "doc_id", file_count(docs, 500))
    rows = docs.selectExpr(
        "'baseline' AS folder", f"{file} AS file", "doc_id", "lang", "source",
        rf"split({_ESCAPED}, '\n', -1) AS lines",
    )
    return Placed(rows, ("doc_id",), xml)


_YEAR, _MON = "year(o_orderdate)", "date_format(o_orderdate, 'MMM')"

# Thirteen ways to state a date, by form number.
_DATE_FORMS = (
    (_YEAR, _MON, "day(o_orderdate)", None),
    (_YEAR, f"upper({_MON})", "date_format(o_orderdate, 'dd')", None),
    (_YEAR, None, None, None),
    (_YEAR, "month(o_orderdate)", "day(o_orderdate)", None),
    (_YEAR, "date_format(o_orderdate, 'MM')", None, None),
    (_YEAR, "'Feb'", "'30'", None),
    (_YEAR, "'September'", "'01'", None),
    (f"{_YEAR} - 150", "'Jan'", "'01'", None),
    (None, None, None, None),
    (None, None, None, f"concat({_YEAR}, ' Dec-', {_YEAR} + 1, ' Jan')"),
    (None, None, None, f"concat('Spring ', {_YEAR} - 150)"),
    (None, None, None, "'Spring'"),
    (None, None, None, f"concat('Spring ', {_YEAR}, '1')"),
)
_DATE_TAGS = ("Year", "Month", "Day", "MedlineDate")


def _date(forms: int) -> str:
    cases = []
    for number, values in enumerate(_DATE_FORMS[:forms]):
        filled = [_el(tag, value) for tag, value in zip(_DATE_TAGS, values) if value]
        cases.append(f"WHEN {number} THEN concat({', '.join(filled) or repr('')})")
    return f"CASE o_orderkey % {forms} {' '.join(cases)} END"


_AUTHOR = f"""CASE o_custkey % 4
    WHEN 0 THEN concat({_el('LastName', "'C', o_custkey")}, {_el('ForeName', 'o_orderstatus')},
                       '<Initials>I</Initials>')
    WHEN 1 THEN concat({_el('LastName', "'C', o_custkey")}, {_el('Initials', 'o_orderstatus')})
    WHEN 2 THEN concat({_el('CollectiveName', "'G', o_custkey")})
    ELSE concat({_el('LastName', "'C', o_custkey")}) END"""
_AUTHORS = (
    f"'<AuthorList>\\n<Author>', {_AUTHOR}, '</Author>\\n<Author>', "
    f"{_el('LastName', repr('N') + ', o_orderkey % 25')}, '</Author>\\n</AuthorList>\\n'"
)


def _doi_id(value: str) -> str:
    return (
        "'<ArticleIdList><ArticleId IdType=\"doi\">', "
        f"{value}, '</ArticleId></ArticleIdList>'"
    )


_OWN = _doi_id("'10.1/o', o_orderkey")
_NO_DOI = "'<ArticleIdList><ArticleId IdType=\"pubmed\">1</ArticleId></ArticleIdList>'"
_CITED = (
    "'<ReferenceList><Reference><Citation>c</Citation></Reference><Reference>', "
    + _doi_id("'10.2/c', o_custkey") + ", '</Reference></ReferenceList>'"
)
_IDS = f"""CASE o_orderkey % 5
    WHEN 0 THEN concat({_OWN}, {_CITED})
    WHEN 1 THEN concat({_NO_DOI}, {_CITED})
    WHEN 2 THEN {_NO_DOI}
    WHEN 3 THEN concat({_doi_id("''")}, {_CITED})
    ELSE concat('<ReferenceList>', {_CITED}, '</ReferenceList>') END"""


def _named(tag: str, ui: str, body: str) -> str:
    return f"'<{tag} UI=\"D', {ui}, '\">', {body}, '</{tag}>'"


_CHEMICALS = f"""'<ChemicalList>\\n<Chemical>',
    {_named('NameOfSubstance', 'o_custkey % 20', "'chem ', o_custkey % 20")},
    '</Chemical>\\n<Chemical>', if(o_orderkey % 6 = 0, '<NameOfSubstance>plain</NameOfSubstance>',
    concat({_named('NameOfSubstance', 'o_orderkey % 20', "'chem ', o_orderkey % 20")})),
    '</Chemical>\\n</ChemicalList>\\n'"""
_HEADINGS = "'<MeshHeadingList>\\n', " + ", ".join(
    f"'<MeshHeading>', {_named('DescriptorName', ui, body)}, '</MeshHeading>\\n'"
    for ui, body in (
        ("o_custkey % 20", "'head ', o_custkey % 20"),
        ("(o_orderkey + 7) % 20", "if(o_orderkey % 9 = 0, '<i>in</i>', ''), 'head'"),
        ("(o_custkey + 1) % 20", "'head ', (o_custkey + 1) % 20"),
    )
) + ", '</MeshHeadingList>\\n'"


# What the records of an order are made of.
_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    file = _shard("ord-", "o_orderkey", file_count(orders, 4000))
    return orders.selectExpr("'baseline' AS folder", f"{file} AS file", *_ORDER_COLUMNS)


def articles(spark: SparkSession, sf_dir: str) -> Placed:
    """``orders``: dates in thirteen forms, authors, journals, DOIs, compounds and headings."""
    xml = f"""concat('<PubmedArticle>\\n<MedlineCitation>\\n', {_id('o_orderkey')},
        '<Article>\\n<Journal>\\n<JournalIssue><PubDate>', {_date(13)},
        '</PubDate></JournalIssue>\\n', {_el('Title', 'o_orderpriority')},
        if(o_orderstatus = 'P', '', concat({_el('ISOAbbreviation', 'o_orderstatus')})),
        '</Journal>\\n', {_el('ArticleTitle', "'Order ', o_orderkey, ' &amp; <i>customer</i>'")},
        {_AUTHORS}, '</Article>\\n', {_CHEMICALS}, {_HEADINGS},
        '</MedlineCitation>\\n<PubmedData>', {_IDS}, '</PubmedData>\\n</PubmedArticle>')"""
    return Placed(_orders(spark, sf_dir), ("o_orderkey",), xml)


def books(spark: SparkSession, sf_dir: str) -> Placed:
    """``orders`` as books: a title with inline tag, a date, two author lists, an abstract."""
    editor = _el("LastName", "'E', o_custkey % 7")
    label = "if(o_orderkey % 3 = 0, '', ' Label=\"ABOUT\"')"
    xml = f"""concat('<PubmedBookArticle>\\n<BookDocument>\\n', {_id('o_orderkey')}, '<Book>\\n',
        {_el('BookTitle', "'Book ', o_orderkey, '<i>x</i> end'")},
        '\\n<PubDate>', {_date(9)}, '</PubDate>\\n<AuthorList><Author>', {editor},
        '</Author></AuthorList>\\n</Book>\\n', {_AUTHORS}, '<Abstract>\\n<AbstractText', {label},
        '>', o_orderpriority, ' <b>of</b> ', o_orderstatus, '</AbstractText>\\n</Abstract>\\n',
        '</BookDocument>\\n<PubmedBookData/>\\n</PubmedBookArticle>')"""
    return Placed(_orders(spark, sf_dir), ("o_orderkey",), xml)


# All columns a change depends on: rows that tie on them are the same change.
CHANGE_KEY = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
    "l_returnflag",
)
CHANGE_SPREAD = "l_orderkey + 7 * l_linenumber + 13 * l_partkey + 31 * l_suppkey"


def place_changes(lines: DataFrame) -> DataFrame:
    """``lineitem`` with the folder and file each line's change goes to."""
    file = _shard("chg-", CHANGE_SPREAD, file_count(lines, 8000))
    return lines.selectExpr(
        "if(l_shipdate < '1998-01-01', 'baseline', 'updatefiles') AS folder", f"{file} AS file", "*"
    )


def revisions(spark: SparkSession, sf_dir: str) -> Placed:
    """``lineitem``: versions of parts, and delete blocks for the part and the supplier key."""
    placed = place_changes(table(spark, sf_dir, "lineitem"))
    xml = f"""if(l_returnflag = 'R' AND l_linenumber = 1,
        concat('<DeleteCitation>\\n', {_id('l_partkey')}, {_id('l_suppkey')}, '</DeleteCitation>'),
        concat('<PubmedArticle>\\n<MedlineCitation>\\n', {_id('l_partkey')}, '<Article>\\n',
               {_el('ArticleTitle', "l_orderkey, '-', l_linenumber, '-', l_suppkey")},
               '\\n</Article>\\n</MedlineCitation>\\n</PubmedArticle>'))"""
    return Placed(placed.select("folder", "file", *CHANGE_KEY), CHANGE_KEY, xml)


def kinds(spark: SparkSession, sf_dir: str) -> Placed:
    """``events``: one element kind per event type, two for errors.

    Deletes and errors go to files of their own, which so hold no article and no book.
    """
    events = table(spark, sf_dir, "events")
    book = f"""'<BookDocument>', {_id('event_id')},
        '<Book><BookTitle>B</BookTitle></Book></BookDocument>'"""
    xml = f"""CASE
        WHEN event_type = 'view' THEN concat('<PubmedArticle><MedlineCitation>',
            {_id('event_id')}, '<Article></Article></MedlineCitation></PubmedArticle>')
        WHEN event_type = 'click' THEN concat('<PubmedBookArticle>', {book}, '</PubmedBookArticle>')
        WHEN event_type = 'signup' THEN concat({book})
        WHEN event_type = 'purchase' THEN
            concat('<DeleteCitation>', {_id('event_id')}, {_id('user_id')}, '</DeleteCitation>')
        WHEN event_id % 2 = 0 THEN concat('<DeleteDocument>', event_id, '</DeleteDocument>')
        ELSE concat('<Retraction id="', event_id, '"/>') END"""
    without = "event_type IN ('purchase', 'error')"
    name = f"""concat('evt-', if({without}, 'del-', 'art-'),
        lpad(cast(event_id % {file_count(events, 2500)} as string), 6, '0'))"""
    rows = events.selectExpr(
        "'updatefiles' AS folder", f"{name} AS file", "event_id", "event_type", "user_id"
    )
    return Placed(rows, ("event_id",), xml)


Renderer = Callable[[SparkSession, str], Placed]

_written: dict[tuple[str, str, str], str] = {}


def corpus_dir(spark: SparkSession, sf_dir: str, render: Renderer) -> str:
    """Folder of a rendered corpus, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, render.__name__)
    if key not in _written:
        path = new_dir(spark, render.__name__)
        _write(render(spark, sf_dir), path)
        _written[key] = path
    return _written[key]


def corpus(
    spark: SparkSession, sf_dir: str, render: Renderer, kind: str = ARTICLE, phase: int | None = None
) -> DataFrame:
    """Scanned records of a rendered corpus, or those of one phase: the condition stands on the
    path, ahead of the split, so Spark opens that phase's files only."""
    chunks = read_chunks(spark, corpus_dir(spark, sf_dir, render), kind)
    if phase is not None:
        chunks = chunks.where(phase_of(folder_name(F.col("path"))) == phase)
    return split_records(chunks, folder_name, kind)
