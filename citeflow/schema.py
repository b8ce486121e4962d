"""Table schemas and the XML shapes the parser asks Spark for.

``from_xml`` builds every column it is given, used or not, so a job that needs two fields
should ask for two fields: ``xml_schema`` cuts the full shape down to the wanted paths.
"""

from __future__ import annotations

from collections.abc import Iterable

ARTICLE, BOOK, DELETE = "PubmedArticle", "PubmedBookArticle", "DeleteCitation"
HANDLED = (ARTICLE, BOOK, DELETE)

TERM = "STRUCT<id: STRING, name: STRING>"

DOC = (
    "pmid STRING, title STRING, abstract STRING, authors ARRAY<STRING>, pub_date STRING, "
    "journal_iso_title STRING, journal_title STRING, article_types ARRAY<STRING>, doi STRING, "
    f"compounds ARRAY<{TERM}>, mesh ARRAY<{TERM}>, source_file STRING"
)
DOC_FIELDS = (
    "title", "abstract", "authors", "pub_date", "journal_iso_title", "journal_title",
    "article_types", "doi", "compounds", "mesh",
)

SETTINGS = "buckets INT"
LEDGER = "file_key STRING, fn STRING, article_cnt BIGINT, duration DOUBLE"

# op: U document, D tombstone, X quarantined record (raw_xml and error say which and why),
# S element of an unhandled kind.
# (phase, file, seq, block, ord) is the total order in which changes apply; seq numbers the loads
# of a store, so a file that is loaded again replaces its older version.
CHANGE = (
    "op STRING, pmid STRING, phase INT, file STRING, seq BIGINT, block BIGINT, ord BIGINT, "
    f"kind STRING, error STRING, raw_xml STRING, doc STRUCT<{DOC}>"
)
CHANGE_ORDER = ("phase", "file", "seq", "block", "ord")

# Mixed content comes back as the list of its direct text nodes.
_TEXT = "STRUCT<_VALUE: ARRAY<STRING>>"
_ID = "STRUCT<_VALUE: STRING>"
_YMD = {"Year": "STRING", "Month": "STRING", "Day": "STRING"}
_AUTHORS = (
    f"ARRAY<STRUCT<Author: ARRAY<STRUCT<LastName: {_TEXT}, ForeName: {_TEXT}, Initials: {_TEXT}>>>>"
)
_ABSTRACT = "STRUCT<AbstractText: ARRAY<STRUCT<_VALUE: ARRAY<STRING>, _Label: STRING>>>"
_NAMED = "STRUCT<_VALUE: ARRAY<STRING>, _UI: STRING>"
_IDS = "STRUCT<ArticleId: ARRAY<STRUCT<_VALUE: ARRAY<STRING>, _IdType: STRING>>>"
_REFERENCE = f"Reference: ARRAY<STRUCT<ArticleIdList: {_IDS}>>"
_REFERENCES = f"ARRAY<STRUCT<{_REFERENCE}, ReferenceList: ARRAY<STRUCT<{_REFERENCE}>>>>"

XML_SHAPE = {
    "MedlineCitation": {
        "PMID": _ID,
        "DateCreated": dict(_YMD),
        "Article": {
            "_PubModel": "STRING",
            "Journal": {
                "JournalIssue": {"PubDate": {**_YMD, "MedlineDate": "STRING"}},
                "Title": _TEXT,
                "ISOAbbreviation": _TEXT,
            },
            "ArticleTitle": _TEXT,
            "BookTitle": _TEXT,
            "Abstract": _ABSTRACT,
            "AuthorList": _AUTHORS,
            "PublicationTypeList": f"STRUCT<PublicationType: ARRAY<{_TEXT}>>",
        },
        "ChemicalList": f"STRUCT<Chemical: ARRAY<STRUCT<NameOfSubstance: {_NAMED}>>>",
        "MeshHeadingList": f"STRUCT<MeshHeading: ARRAY<STRUCT<DescriptorName: {_NAMED}>>>",
    },
    "PubmedData": {"ArticleIdList": _IDS, "ReferenceList": _REFERENCES},
    "BookDocument": {
        "PMID": _ID,
        "Book": {"BookTitle": _TEXT, "PubDate": dict(_YMD), "AuthorList": _AUTHORS},
        "AuthorList": _AUTHORS,
        "Abstract": _ABSTRACT,
    },
}

CORRUPT = "_corrupt"


def _ddl(shape: dict, prefix: str, wanted: tuple[str, ...]) -> list[str]:
    fields = []
    for name, sub in shape.items():
        path = f"{prefix}{name}"
        whole = any(path == w or path.startswith(w + ".") for w in wanted)
        if isinstance(sub, dict):
            inner = _ddl(sub, path + ".", wanted)
            if inner:
                fields.append(f"{name} STRUCT<{', '.join(inner)}>")
        elif whole:
            fields.append(f"{name} {sub}")
    return fields


def xml_schema(paths: Iterable[str]) -> str:
    """DDL of the record shape, restricted to the given dotted paths."""
    return ", ".join([*_ddl(XML_SHAPE, "", tuple(paths)), f"{CORRUPT} STRING"])
