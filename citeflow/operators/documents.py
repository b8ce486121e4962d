"""Records to documents.

``parse_records`` parses each record once and judges it; the field builders below read the
parsed struct. Ask for the fields a job needs: the parser then builds only those.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeflow.functions.dates import FALLBACK_DATE, DateParts, created_date, date_parts, pub_date, unparsable
from citeflow.functions.text import (
    bind, first_text, has_text, html_text, labelled_text, leading_text, mark, plain,
)
from citeflow.schema import ARTICLE, BOOK, CORRUPT, DOC_FIELDS, TERM, xml_schema

_ART = "MedlineCitation.Article"
_BOOK = "BookDocument.Book"

# Read for every job: the id, and what a record must have to be loaded.
_ALWAYS = ("MedlineCitation.PMID", f"{_ART}._PubModel", "BookDocument.PMID", f"{_BOOK}.BookTitle")

# Error texts of quarantined records.
MALFORMED = "malformed xml"
NO_ID = "no record id"
NO_ARTICLE = "no article"
NO_BOOK_TITLE = "no book title"


class _Field(NamedTuple):
    """``empty`` is what ``build`` makes of a record with none of the paths, where that costs work."""

    paths: tuple[str, ...]
    build: Callable[[Column], Column]
    empty: Callable[[], Column] | None = None


def _at(v: Column, path: str) -> Column:
    for name in path.split("."):
        v = v[name]
    return v


def _empty(element: str) -> Column:
    return F.array().cast(f"ARRAY<{element}>")


def _blank() -> Column:
    return F.lit("")


def _title(v: Column) -> Column:
    titles = (f"{_ART}.ArticleTitle", f"{_ART}.BookTitle", f"{_BOOK}.BookTitle")
    return F.coalesce(*(first_text(_at(v, t)["_VALUE"]) for t in titles), F.lit(""))


def _article_title_lead(v: Column) -> Column:
    return leading_text(_at(v, f"{_ART}.ArticleTitle._VALUE"))


def _abstract(v: Column) -> Column:
    parts = (_at(v, f"{_ART}.Abstract.AbstractText"), _at(v, "BookDocument.Abstract.AbstractText"))
    return labelled_text(F.coalesce(*parts))


def _abstract_html(v: Column) -> Column:
    return html_text(_at(v, f"{_ART}.Abstract.AbstractText"))


def _authors_in(lists: Column) -> Column:
    authors = F.flatten(F.filter(lists["Author"], lambda a: a.isNotNull()))

    def name(author: Column) -> Column:
        last, fore, initials = (
            first_text(author[part]["_VALUE"]) for part in ("LastName", "ForeName", "Initials")
        )
        return F.concat(
            F.coalesce(last, F.lit("")), F.lit(", "), F.coalesce(fore, initials, F.lit(""))
        )

    return F.coalesce(F.transform(authors, name), _empty("STRING"))


def _authors(v: Column) -> Column:
    lists = (f"{_ART}.AuthorList", f"{_BOOK}.AuthorList", "BookDocument.AuthorList")
    return F.concat(*(_authors_in(_at(v, path)) for path in lists))


def record_date_parts(v: Column) -> DateParts:
    """Year, month and day of a record's date, gaps filled; books have no free-text date."""
    journal = _at(v, f"{_ART}.Journal.JournalIssue.PubDate")
    book = _at(v, f"{_BOOK}.PubDate")
    return date_parts(
        *(F.coalesce(journal[part], book[part]) for part in ("Year", "Month", "Day")),
        medline=journal["MedlineDate"],
    )


def _date_struct(v: Column) -> Column:
    return F.struct(*(c.alias(n) for n, c in record_date_parts(v)._asdict().items()))


def _pub_date(v: Column) -> Column:
    return bind(_date_struct(v), lambda d: pub_date(DateParts(d["year"], d["month"], d["day"])))


def _date_check(v: Column) -> Column:
    """The parts of the date and whether they fail to make one."""
    return bind(_date_struct(v), lambda d: F.struct(
        d["year"].alias("year"), d["month"].alias("month"), d["day"].alias("day"),
        unparsable(DateParts(d["year"], d["month"], d["day"])).alias("bad"),
    ))


def _journal(child: str) -> Callable[[Column], Column]:
    path = f"{_ART}.Journal.{child}._VALUE"
    return lambda v: F.coalesce(first_text(_at(v, path)), F.lit(""))


def _article_types(v: Column) -> Column:
    types = _at(v, f"{_ART}.PublicationTypeList.PublicationType")
    return F.coalesce(
        F.transform(types, lambda t: leading_text(t["_VALUE"])), _empty("STRING")
    )


def _first_doi(ids: Column) -> Column:
    dois = F.filter(ids, lambda i: (i["_IdType"] == "doi") & first_text(i["_VALUE"]).isNotNull())
    return first_text(F.get(dois, F.lit(0))["_VALUE"])


def _cited_ids(references: Column) -> Column:
    lists = F.transform(references, lambda r: r["ArticleIdList"]["ArticleId"])
    return F.flatten(F.filter(lists, lambda ids: ids.isNotNull()))


def _doi(v: Column) -> Column:
    """First DOI anywhere in the record: its own, else one of a cited work."""
    lists = _at(v, "PubmedData.ReferenceList")
    cited = F.transform(
        lists,
        lambda r: F.coalesce(
            _first_doi(_cited_ids(r["Reference"])),
            _first_doi(_cited_ids(F.flatten(
                F.filter(r["ReferenceList"]["Reference"], lambda x: x.isNotNull())
            ))),
        ),
    )
    first_cited = F.get(F.filter(cited, lambda d: d.isNotNull()), F.lit(0))
    own = _first_doi(_at(v, "PubmedData.ArticleIdList.ArticleId"))
    # Deeper reference lists: a path expression over the raw text, only for well-formed records
    # that the paths above found nothing in and whose text holds a doi id at all.
    raw = F.col("raw_xml")
    deeper = F.when(
        v[CORRUPT].isNull() & F.contains(raw, F.lit('IdType="doi"')),
        F.nullif(F.expr(f"xpath_string(raw_xml, '{_ANY_DOI}')"), F.lit("")),
    )
    listed = F.when(v["PubmedData"].isNotNull(), F.coalesce(own, first_cited))
    return F.when(_at(v, "BookDocument").isNull(), F.coalesce(listed, deeper)).otherwise("")


# The first doi id in document order whose text is not blank.
_ANY_DOI = 'normalize-space((//ArticleId[@IdType="doi"][normalize-space(text())])[1]/text())'



def _own_doi(v: Column) -> Column:
    own = _first_doi(_at(v, "PubmedData.ArticleIdList.ArticleId"))
    return F.when(_at(v, "BookDocument").isNull(), own).otherwise("")


def _names(v: Column, path: str) -> Column:
    return F.filter(_at(v, path), lambda n: n.isNotNull())


def _ui(node: Column) -> Column:
    return F.coalesce(node["_UI"], F.lit("None"))


def _terms(nodes: Column) -> Column:
    """Id and name of each node that names a compound or a heading."""

    def term(node: Column) -> Column:
        name = leading_text(node["_VALUE"])
        return F.struct(F.concat(F.lit("MESH:"), _ui(node)).alias("id"), name.alias("name"))

    return F.coalesce(F.transform(nodes, term), _empty(TERM))


_CHEMICALS = "MedlineCitation.ChemicalList.Chemical.NameOfSubstance"
_HEADINGS = "MedlineCitation.MeshHeadingList.MeshHeading.DescriptorName"


def _compounds(v: Column) -> Column:
    return _terms(_names(v, _CHEMICALS))


def _mesh_all(v: Column) -> Column:
    return _terms(_names(v, _HEADINGS))


def _mesh(v: Column) -> Column:
    """Headings that are not among the compounds."""
    headings = _names(v, _HEADINGS)
    others = bind(
        F.transform(_names(v, _CHEMICALS), _ui),
        lambda uis: F.filter(headings, lambda h: ~F.array_contains(uis, _ui(h))),
    )
    has_compounds = _at(v, _CHEMICALS).isNotNull()
    return _terms(F.when(has_compounds, others).otherwise(headings))


def _created_date(v: Column) -> Column:
    created = _at(v, "MedlineCitation.DateCreated")
    return created_date(created["Year"], created["Month"], created["Day"])


def _string_value(path: str) -> Column:
    """Whole text of the first element at ``path`` in the raw record, inline tags' text included,
    blanks kept; NULL if there is none or it is empty."""
    return F.nullif(F.expr(f"xpath_string(raw_xml, 'string(({path})[1])')"), F.lit(""))


def _full_title(v: Column) -> Column:
    """The title as its whole text: the first of article title, book title in an article, and
    book title that is not empty; '' if none is. Malformed records, which do not load, get NULL."""
    whole = F.coalesce(
        _string_value("/*/MedlineCitation/Article/ArticleTitle"),
        _string_value("/*/MedlineCitation/Article/BookTitle"),
        _string_value("/*/BookDocument/Book/BookTitle"),
        F.lit(""),
    )
    return F.when(v[CORRUPT].isNull(), whole)


_MESH_PATH = "MedlineCitation.MeshHeadingList"
_TITLE_PATHS = (f"{_ART}.ArticleTitle", f"{_ART}.BookTitle", f"{_BOOK}.BookTitle")
_DATE_PATHS = (f"{_ART}.Journal.JournalIssue", f"{_BOOK}.PubDate")

FIELDS = {
    "title": _Field(_TITLE_PATHS, _title),
    "abstract": _Field((f"{_ART}.Abstract", "BookDocument.Abstract"), _abstract, _blank),
    "authors": _Field(
        (f"{_ART}.AuthorList", f"{_BOOK}.AuthorList", "BookDocument.AuthorList"), _authors,
        lambda: _empty("STRING"),
    ),
    "pub_date": _Field(_DATE_PATHS, _pub_date, lambda: F.lit(FALLBACK_DATE)),
    "journal_iso_title": _Field((f"{_ART}.Journal.ISOAbbreviation",), _journal("ISOAbbreviation"), _blank),
    "journal_title": _Field((f"{_ART}.Journal.Title",), _journal("Title"), _blank),
    "article_types": _Field((f"{_ART}.PublicationTypeList",), _article_types, lambda: _empty("STRING")),
    "doi": _Field(("PubmedData",), _doi),
    "compounds": _Field(("MedlineCitation.ChemicalList",), _compounds, lambda: _empty(TERM)),
    "mesh": _Field((_MESH_PATH, "MedlineCitation.ChemicalList"), _mesh, lambda: _empty(TERM)),
    # Other projections of the same records.
    "full_title": _Field(_TITLE_PATHS, _full_title),
    "own_doi": _Field(("PubmedData.ArticleIdList",), _own_doi),
    "mesh_all": _Field((_MESH_PATH,), _mesh_all),
    "lead_title": _Field((f"{_ART}.ArticleTitle",), _article_title_lead),
    "abstract_html": _Field((f"{_ART}.Abstract",), _abstract_html),
    "created_date": _Field(("MedlineCitation.DateCreated",), _created_date),
    "date_check": _Field(_DATE_PATHS, _date_check),
    "medline_text": _Field(
        (f"{_ART}.Journal.JournalIssue",),
        lambda v: plain(_at(v, f"{_ART}.Journal.JournalIssue.PubDate.MedlineDate")),
    ),
    "abstract_parts": _Field(
        (f"{_ART}.Abstract",), lambda v: _at(v, f"{_ART}.Abstract.AbstractText")
    ),
}

_XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": CORRUPT}


def record_id(v: Column) -> Column:
    return F.coalesce(
        plain(_at(v, "MedlineCitation.PMID._VALUE")), plain(_at(v, "BookDocument.PMID._VALUE"))
    )


def record_error(kind: Column, v: Column) -> Column:
    """Why a record cannot be loaded; NULL if it can."""
    has_book_title = has_text(_at(v, f"{_BOOK}.BookTitle._VALUE"))
    return (
        F.when(v[CORRUPT].isNotNull(), MALFORMED)
        .when(record_id(v).isNull(), NO_ID)
        .when((kind == ARTICLE) & _at(v, _ART).isNull(), NO_ARTICLE)
        .when((kind == BOOK) & ~has_book_title, NO_BOOK_TITLE)
    )


PARSED = "_parsed"


def with_parsed(records: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Adds the parsed struct of article and book records, NULL for every other kind.

    The struct passes through a one-element generator: Spark pushes filters below a projection
    but not below a generator, so a filter on parsed fields does not parse the record again.
    """
    paths = [*_ALWAYS, *(path for field in fields for path in FIELDS[field].paths)]
    struct = F.from_xml(mark(F.col("raw_xml")), xml_schema(paths), _XML_OPTIONS)
    loadable = F.when(F.col("kind").isin(ARTICLE, BOOK), struct)
    return records.select("*", F.explode(F.array(loadable)).alias(PARSED))


def field(v: Column, name: str) -> Column:
    rule = FIELDS[name]
    if rule.empty is None:
        return rule.build(v)
    present = (_at(v, path).isNotNull() for path in rule.paths)
    return F.when(reduce(Column.__or__, present), rule.build(v)).otherwise(rule.empty())


def parse_records(records: DataFrame, fields: Sequence[str] = DOC_FIELDS) -> DataFrame:
    """Article and book records with ``pmid``, ``error`` and the asked fields added."""
    v, kind = F.col(PARSED), F.col("kind")
    return with_parsed(records.where(kind.isin(ARTICLE, BOOK)), fields).select(
        *records.columns,
        record_id(v).alias("pmid"),
        record_error(kind, v).alias("error"),
        *(field(v, name).alias(name) for name in fields),
    )


def documents(records: DataFrame, fields: Sequence[str] = DOC_FIELDS) -> DataFrame:
    """Documents of all loadable records: pmid, the asked fields, source_file."""
    loaded = parse_records(records, fields).where(F.col("error").isNull())
    return loaded.select("pmid", *fields, F.col("file").alias("source_file"))


def search_rows(records: DataFrame) -> DataFrame:
    """An id row and a source row per article, the shape a search index takes."""
    docs = documents(
        records.where(F.col("kind") == ARTICLE), ("lead_title", "created_date", "abstract_html")
    )
    return docs.select(
        "pmid",
        F.struct(
            F.col("lead_title").alias("title"), "created_date",
            F.col("abstract_html").alias("abstract"),
        ).alias("source"),
    )
