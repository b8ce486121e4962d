"""Publication-date rule, built from the parts a record gives as text."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeflow.functions.text import bind, plain

FALLBACK_DATE = "1900-01-01"
FALLBACK_YEAR = "1900"

# Texts a date may carry: a year of four digits, a day from 1 to 31, padded with a zero or not.
_YEAR = "^[0-9]{4}$"
_DAY = "^(3[01]|[12][0-9]|0[1-9]|[1-9])$"

# The month names a date may carry, in any case.
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"


class DateParts(NamedTuple):
    year: Column
    month: Column
    day: Column


def medline_year(text: Column, default: Column) -> Column:
    """First four digits in a row of a free-text date, not before 1900."""
    found = F.nullif(F.regexp_extract(text, "[0-9]{4}", 0), F.lit(""))
    year = F.coalesce(found, default)
    return F.when(year.try_cast("int") < 1900, FALLBACK_YEAR).otherwise(year)


def date_parts(
    year: Column, month: Column, day: Column, medline: Column | None = None
) -> DateParts:
    """Fill in missing parts; a free-text date, where there is one, decides on the year."""
    year = F.coalesce(plain(year), F.lit(FALLBACK_YEAR))
    if medline is not None:
        text = plain(medline)
        year = F.when(text.isNull(), year).otherwise(medline_year(text, year))
    return DateParts(
        year,
        F.coalesce(plain(month), F.lit("Jan")),
        F.coalesce(plain(day), F.lit("01")),
    )


def _named_month(parts: DateParts) -> Column:
    return parts.month.rlike("^[a-zA-Z]")


def _parsed(parts: DateParts) -> Column:
    """The date as ``yyyy-MM-dd``, NULL if the parts make none.

    The text is put together and tried as a date, which costs less than parsing by a pattern:
    that raises and drops an exception for every text it cannot read.
    """
    valid = (
        (F.length(parts.month) == 3) & parts.day.rlike(_DAY) & parts.year.rlike(_YEAR) & (parts.year != "0000")
    )

    def checked(text: Column) -> Column:
        return F.when(text.try_cast("date").isNotNull(), text)

    def at_month(at: Column) -> Column:
        month = F.lpad(((at + 3) / 4).cast("int").cast("string"), 2, "0")
        text = F.concat_ws("-", parts.year, month, F.lpad(parts.day, 2, "0"))
        return F.when(at % 4 == 1, bind(text, checked))

    return F.when(valid, bind(F.position(F.lower(parts.month), F.lit(_MONTHS)), at_month))


def pub_date(parts: DateParts) -> Column:
    """Month names are parsed and checked; other months are joined as they stand."""
    parsed = F.coalesce(_parsed(parts), F.lit(FALLBACK_DATE))
    return F.when(_named_month(parts), parsed).otherwise(F.concat_ws("-", *parts))


def unparsable(parts: DateParts) -> Column:
    return _named_month(parts) & _parsed(parts).isNull()


def created_date(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", plain(year), plain(month), plain(day)), "y-M-d")
