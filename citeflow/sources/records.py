"""Record files: cut gzip XML into one row per record.

The text reader splits at the end tag of the commonest record, so a task streams through its
file chunk by chunk and never holds it whole; everything else (books, delete blocks, unknown
elements) is found inside the chunks. A gzip file is read by one task, so keep files of similar
size; plain XML splits.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from citeflow.schema import ARTICLE, DELETE, HANDLED

# Outermost elements of a chunk, the set roots aside: open tag to its own end tag, or empty.
_ELEMENT = (
    r"(?s)<(?!PubmedArticleSet\b|PubmedBookArticleSet\b)([A-Za-z][\w.-]*)(?:\s[^>]*?)?"
    r"(?:/>|>.*?</\1\s*>)"
)
_TAG = r"^<([\w.-]+)"
_HANDLED_TAG = rf"<({'|'.join(HANDLED)})[\s>]"
# Fixed value: how the raw text states a record's id.
_VERSIONED_ID = r'<PMID Version="\d+">(\d+)</PMID'
_BLOCK_ID = r"<PMID[^>]*>\s*([^<\s]+)\s*</PMID>"

NameRule = Callable[[Column], Column]


_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def relative_to(data_dir: str) -> NameRule:
    """Name a file by its path below ``data_dir``; a path elsewhere keeps its whole name."""
    base = re.sub(_AUTHORITY, "", data_dir) if re.match(_AUTHORITY, data_dir) else os.path.abspath(data_dir)
    prefix = base.rstrip("/") + "/"

    def name(path: Column) -> Column:
        bare = F.regexp_replace(path, _AUTHORITY, "")
        below = F.substring(bare, len(prefix) + 1, 1 << 30)
        return F.when(bare.startswith(prefix), below).otherwise(bare)

    return name


def plain_path() -> Column:
    """Path of a scanned file as it is written; Spark's metadata column gives it URL-encoded."""
    encoded = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(encoded, F.lit("%")), decoded).otherwise(encoded)


def phase_of(file: Column) -> Column:
    """0 for the baseline folder, 1 for everything that updates it."""
    return F.when(file.startswith("baseline/"), 0).otherwise(1)


# The root elements of record files.
ROOTS = ("PubmedArticleSet", "PubmedBookArticleSet")
_ROOT_END = "ArticleSet"


def _options(separator: str) -> dict[str, str]:
    # A damaged file (a cut gzip stream) gives what could be read; `observed` tells it apart.
    return {"lineSep": separator, "recursiveFileLookup": "true", "ignoreCorruptFiles": "true"}


CLOCK = "read_ns"


def clocked(chunks: DataFrame) -> DataFrame:
    """Each chunk with the reading of its executor's clock when the task reached it.

    Rows flow through a task one by one, so the spread of a file's readings within one task is
    the time that task spent on the file, parse included where it runs in the same stage.
    """
    return chunks.withColumn(CLOCK, F.expr("reflect('java.lang.System', 'nanoTime')").cast("bigint"))


def _named(chunks: DataFrame, name: NameRule) -> DataFrame:
    """The chunks with their file's name, worked out once however often it is used: a projection
    is not merged with what stands above an observation or a generator."""
    return chunks if "file" in chunks.columns else chunks.withColumn("file", name(F.col("path")))


def observed(chunks: DataFrame, name: NameRule, kind: str = ARTICLE) -> tuple[DataFrame, Observation]:
    """The chunks, and what the job that reads them finds: files whose root opens and closes, and
    files with a chunk in which no ``kind`` record begins.

    The names are gathered while the chunks are read for any other purpose; no second pass. A chunk
    in which a record begins gives a row of changes, so its file need not be gathered here.
    """
    value, file = F.col("value"), F.col("file")
    # Both roots end so; most chunks hold neither and are searched once.
    rooted = F.contains(value, F.lit(_ROOT_END))
    opens = F.lit(False)
    closes = F.lit(False)
    for root in ROOTS:
        opens = opens | F.contains(value, F.lit(f"<{root}"))
        closes = closes | F.contains(value, F.lit(f"</{root}"))
    begins = F.contains(value, F.lit(f"<{kind}>"))
    seen = Observation()
    marked = _named(chunks, name).observe(
        seen, F.collect_set(F.when(rooted & opens, file)).alias("opened"),
        F.collect_set(F.when(rooted & closes, file)).alias("closed"),
        F.collect_set(F.when(~begins, file)).alias("read"),
        F.count(F.lit(1)).alias("chunks"),
    )
    return marked, seen


def silent(seen: Observation, listed: Sequence[str]) -> list[str]:
    """Listed files of which the observation names nothing: those that gave changes were read,
    and of the others nothing could be (empty, or a stream cut so early that no text comes out)."""
    return sorted(set(listed) - set(seen.get["read"] or []))


def damaged(seen: Observation, unread: Sequence[str] = ()) -> list[str]:
    """Files whose root element opens and never closes, and files of which nothing could be read:
    the file ends too early.

    A file without a root element that gives some text cannot be judged and is taken as it is.
    """
    found = seen.get
    return sorted(set(found["opened"] or []) - set(found["closed"] or []) | set(unread))


def _located(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        plain_path().alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def end_tag(kind: str) -> str:
    return f"</{kind}>"


def read_chunks(spark: SparkSession, paths: str | list[str], kind: str = ARTICLE) -> DataFrame:
    return _located(spark.read.options(**_options(end_tag(kind))).text(paths))


def stream_chunks(
    spark: SparkSession, path: str, files_per_batch: int, kind: str = ARTICLE
) -> DataFrame:
    reader = spark.readStream.options(**_options(end_tag(kind))).option("pathGlobFilter", "*.gz")
    return _located(reader.option("maxFilesPerTrigger", files_per_batch).text(path))


def _elements(piece: Column) -> Column:
    """Outermost elements of a piece of text in which no record begins but at its start."""
    tag = F.regexp_extract(piece, f"^{_HANDLED_TAG}", 1)
    unclosed = (tag != "") & ~F.contains(piece, F.concat(F.lit("</"), tag, F.lit(">")))
    found = F.regexp_extract_all(piece, F.lit(_ELEMENT), F.lit(0))
    return F.when(unclosed, F.array(piece)).otherwise(found)


def split_records(chunks: DataFrame, name: NameRule, kind: str = ARTICLE) -> DataFrame:
    """One row per outermost element: file, phase, block, ord, kind, raw_xml.

    A record ends where its end tag or the next record begins, so one without an end tag is a row
    as it stands, which does not parse, and leaves the records after it alone.
    ``ord`` orders the records of one (file, block) and means nothing across them; ``block`` is
    the offset of the file split.
    """
    text = F.ltrim("value", F.lit(" \t\r\n"))
    whole = F.concat(text, F.lit(end_tag(kind)))
    # Most chunks are one record and nothing else; only the others need the search. Tags are looked
    # for only where the kind's name stands again behind the first tag, as part of a tag or as text.
    again = F.substring(text, 3, 1 << 30).contains(kind)
    more = text.contains(f"</{kind}") | (F.locate(f"<{kind}", text, 2) > 0)
    single = text.startswith(f"<{kind}>") & ~(again & more)
    elements = F.flatten(F.transform(F.split(whole, f"(?={_HANDLED_TAG})"), _elements))
    timed = [c for c in (CLOCK,) if c in chunks.columns]
    records = _named(chunks, name).select(
        "file", "block", *timed,
        F.explode(F.when(single, F.array(whole)).otherwise(elements)).alias("raw_xml"),
    )
    tag = F.regexp_extract(F.substring_index("raw_xml", ">", 1), _TAG, 1)
    return records.select(
        "file",
        phase_of(F.col("file")).alias("phase"),
        "block",
        F.monotonically_increasing_id().alias("ord"),
        F.when(F.col("raw_xml").startswith(f"<{kind}>"), kind).otherwise(tag).alias("kind"),
        "raw_xml",
        *timed,
    )


def read_records(
    spark: SparkSession, paths: str | list[str], name: NameRule, kind: str = ARTICLE,
    spread: int | None = None,
) -> DataFrame:
    """Scan record files. ``kind`` is the commonest record: give ``BOOK`` for book files.

    One task reads a gzip file, however large. ``spread`` shuffles the cut records over that
    many partitions, so that few or uneven files do not leave the parsing to a few tasks.
    """
    return _spread_records(split_records(read_chunks(spark, paths, kind), name, kind), spread)


def _spread_records(records: DataFrame, spread: int | None) -> DataFrame:
    return records.repartition(spread, "file", "block", "ord") if spread else records


def read_checked(
    spark: SparkSession, paths: str | list[str], name: NameRule, kind: str = ARTICLE,
    spread: int | None = None,
) -> tuple[DataFrame, Observation]:
    """As :func:`read_records`, with the observation that :func:`damaged` reads after a job."""
    chunks, seen = observed(clocked(read_chunks(spark, paths, kind)), name, kind)
    return _spread_records(split_records(chunks, name, kind), spread), seen


def versioned_id(raw_xml: Column) -> Column:
    """Record id straight from the raw text, without parsing; NULL if there is none."""
    return F.nullif(F.regexp_extract(raw_xml, _VERSIONED_ID, 1), F.lit(""))


def block_ids(raw_xml: Column) -> Column:
    """All ids of a delete block."""
    return F.regexp_extract_all(raw_xml, F.lit(_BLOCK_ID), F.lit(1))


def raw_split(records: DataFrame) -> DataFrame:
    """Article records with the id found in their raw text."""
    return records.where(F.col("kind") == ARTICLE).select(
        "file", versioned_id(F.col("raw_xml")).alias("pmid"), "raw_xml"
    )


def deleted_ids(records: DataFrame) -> DataFrame:
    return records.where(F.col("kind") == DELETE).select(
        "file", F.explode(block_ids(F.col("raw_xml"))).alias("pmid")
    )


def kind_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("kind").agg(F.count("*").alias("records"))


def unhandled_kinds(records: DataFrame) -> DataFrame:
    """Elements that are neither loaded nor deleted, by file."""
    other = records.where(~F.col("kind").isin(*HANDLED))
    return other.groupBy("file", "kind").agg(F.count("*").alias("records"))
