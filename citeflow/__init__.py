"""Bibliographic record files to keyed, queryable documents on Spark."""

from citeflow.operators.documents import documents, parse_records
from citeflow.operators.tables import apply_deletes, insert_if_absent, latest, lookup
from citeflow.plans.store import CitationStore
from citeflow.sources.records import read_records

__all__ = [
    "CitationStore",
    "apply_deletes",
    "documents",
    "insert_if_absent",
    "latest",
    "lookup",
    "parse_records",
    "read_records",
]
