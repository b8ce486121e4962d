"""Column builders for mixed XML content.

Spark's XML reader hands over the direct text nodes of an element as an array, but drops nodes
made of blanks only and does not say whether the first node stands before or after the first
child. A marker character put into the raw text before parsing settles both: it follows every
tag that blanks or another opening tag come after, bare tags of the record's containers aside.
A blank-only node so has a character to keep
it, and an element that opens with a child has a first node that is the bare marker. The marker
is a Unicode noncharacter, so no record carries it as text, and it is removed from all results.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "\ufdd0"

# Elements that hold elements only: what stands directly inside them is never read as text, and
# a marker there would cost the parser a text event.
_CONTAINERS = (
    "PubmedArticle", "PubmedBookArticle", "MedlineCitation", "PubmedData", "BookDocument", "Article", "Book",
    "Journal", "JournalIssue", "PubDate", "DateCreated", "Abstract", "AuthorList", "Author", "PublicationTypeList",
    "ChemicalList", "Chemical", "MeshHeadingList", "MeshHeading", "ArticleIdList", "ReferenceList", "Reference",
)


def _not_after(names: Sequence[str]) -> str:
    """Lookbehinds of one length each, which cost one comparison."""
    lengths = sorted({len(n) for n in names})
    same = ("|".join(n for n in names if len(n) == length) for length in lengths)
    return "".join(f"(?<![</](?:{alternatives})>)" for alternatives in same)


_MARK_AT = r">(?=[ \t\r\n]|<[^/])" + _not_after(_CONTAINERS)


def mark(raw: Column) -> Column:
    return F.regexp_replace(raw, _MARK_AT, ">" + MARK)


def unmark(text: Column) -> Column:
    return F.replace(text, F.lit(MARK), F.lit(""))


def present(text: Column) -> Column:
    """NULL for NULL and for the empty string."""
    return F.nullif(text, F.lit(""))


def plain(text: Column) -> Column:
    """Text of a simple element; NULL if it has none."""
    return present(unmark(text))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used.

    Repeating a long expression also makes generated methods too long for the JVM to compile.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def has_text(nodes: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(nodes, MARK)) > 0, F.lit(False))


def first_text(nodes: Column) -> Column:
    """First text node, wherever it stands. The list is searched only if a child stands first."""
    first = F.get(nodes, F.lit(0))
    searched = F.get(F.filter(nodes, lambda n: n != MARK), F.lit(0))
    return unmark(F.coalesce(F.when(first != MARK, first), searched))


def leading_text(nodes: Column) -> Column:
    """Text before the first child, NULL if there is none."""
    return plain(F.get(nodes, F.lit(0)))


def node_text(nodes: Column) -> Column:
    """Own text and the tails of the children; what the children contain is left out."""
    return unmark(F.coalesce(F.array_join(nodes, ""), F.lit("")))


def strip_end(text: Column) -> Column:
    """Cut trailing whitespace, Unicode blanks included (``rtrim`` cuts spaces only)."""
    return F.regexp_replace(text, r"(?U)\s+\z", "")


def labelled_text(parts: Column) -> Column:
    """One line per part, with the label and a colon in front where the label is not empty."""

    def line(part: Column) -> Column:
        label = present(part["_Label"])
        return F.concat(
            F.coalesce(F.concat(label, F.lit(": ")), F.lit("")),
            F.coalesce(F.array_join(part["_VALUE"], ""), F.lit("")),
            F.lit("\n"),
        )

    return F.coalesce(strip_end(unmark(F.array_join(F.transform(parts, line), ""))), F.lit(""))


def html_text(parts: Column) -> Column:
    """``<b>Label</b>: text<br>`` per part that has leading text."""

    def piece(part: Column) -> Column:
        text = leading_text(part["_VALUE"])
        label = plain(part["_Label"])
        head = F.coalesce(F.concat(F.lit("<b>"), label, F.lit("</b>: ")), F.lit(""))
        return F.coalesce(F.concat(head, text, F.lit("<br>")), F.lit(""))

    return F.coalesce(F.array_join(F.transform(parts, piece), ""), F.lit(""))
