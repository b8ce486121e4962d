"""Records that need a look, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeflow.operators.documents import NO_ID, documents, parse_records
from citeflow.sources.records import raw_split


def bad_records(records: DataFrame) -> DataFrame:
    """Article and book records that cannot be loaded, with the reason."""
    made = parse_records(records, ())
    return made.where(F.col("error").isNotNull()).select("file", "kind", "error", "raw_xml")


def missing_ids(records: DataFrame) -> DataFrame:
    """Well-formed records without an id."""
    return bad_records(records).where(F.col("error") == NO_ID)


def missing_raw_ids(records: DataFrame) -> DataFrame:
    """Article records in whose raw text no id is found, well-formed or not."""
    return raw_split(records).where(F.col("pmid").isNull())


def missing_titles(records: DataFrame) -> DataFrame:
    docs = documents(records, ("title",))
    return docs.where(F.col("title") == "").select("pmid", "source_file")


def bad_dates(records: DataFrame) -> DataFrame:
    """Documents whose named month does not make a date, with the parts as read."""
    docs = documents(records, ("date_check",)).where("date_check.bad")
    return docs.select("pmid", "source_file", *(f"date_check.{p}" for p in ("year", "month", "day")))


def id_mismatch(requests: DataFrame, served: DataFrame) -> DataFrame:
    """Requests answered with another record.

    ``requests`` holds (requested, raw_key): the id asked for and the key of the raw record
    that answered; ``served`` holds (raw_key, pmid): the id found in each raw record.
    """
    answered = requests.join(served, "raw_key")
    return answered.where(F.col("requested") != F.col("pmid")).select("requested", "pmid")
