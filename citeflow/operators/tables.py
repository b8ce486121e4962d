"""Keyed tables as change logs: upsert, delete, insert-if-absent, lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeflow.operators.documents import PARSED, field, record_error, record_id, with_parsed
from citeflow.schema import ARTICLE, BOOK, CHANGE_ORDER, DELETE, DOC_FIELDS
from citeflow.sources.records import block_ids

UPSERT, TOMBSTONE, QUARANTINED, SKIPPED = "U", "D", "X", "S"

# Up to this many ids a lookup is a literal list that the scan can use; beyond it, a join.
LITERAL_IDS = 1000


def changes(
    records: DataFrame, fields: Sequence[str] = DOC_FIELDS, store_raw: bool = False, seq: int = 0,
    choose: Mapping[str, str] | None = None,
) -> DataFrame:
    """All changes that a scan of records asks for, in one pass over them.

    ``choose`` names another rule for a field: ``{"mesh": "mesh_all", "doi": "own_doi"}``. Articles and books become upserts, or quarantined rows if they cannot be loaded; delete
    blocks become one tombstone per id; unhandled kinds leave a row that says so.
    """
    rules = {name: (choose or {}).get(name, name) for name in fields}
    v, kind, raw = F.col(PARSED), F.col("kind"), F.col("raw_xml")
    file, error = F.col("file"), F.col("error")
    loadable = kind.isin(ARTICLE, BOOK)
    ids = (
        F.when(kind == DELETE, block_ids(raw))
        .when(loadable, F.array(record_id(v)))
        .otherwise(F.array(F.lit(None).cast("STRING")))
    )
    kept_raw = raw if store_raw else F.when(error.isNotNull(), raw)
    doc = F.struct(
        record_id(v).alias("pmid"),
        *(field(v, rule).alias(name) for name, rule in rules.items()),
        file.alias("source_file"),
    )
    # Clock readings of the scan, where it took them, pass through to the writer.
    timed = [c for c in ("read_ns",) if c in records.columns]
    judged = with_parsed(records, tuple(rules.values())).select(
        "phase", "file", "block", "ord", "kind", "raw_xml", PARSED, *timed,
        F.when(loadable, record_error(kind, v)).alias("error"),
        F.explode(ids).alias("pmid"),
    )
    op = (
        F.when(error.isNotNull(), QUARANTINED)
        .when(kind == DELETE, TOMBSTONE)
        .when(loadable, UPSERT)
        .otherwise(SKIPPED)
    )
    return judged.select(
        op.alias("op"), "pmid", "phase", "file", F.lit(seq).cast("bigint").alias("seq"), "block", "ord", "kind", "error",
        F.when(loadable, kept_raw).alias("raw_xml"),
        F.when(op == UPSERT, doc).alias("doc"),
        *timed,
    )


def _ranked(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First row per key. Spark cuts each task's rows to one per key before the shuffle, so a
    key that holds a large share of all rows costs one row per task."""
    window = Window.partitionBy(key).orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def _keys(rows: DataFrame, order: Sequence[str]) -> list[str]:
    """The order's columns. Rows of a single scan need no load number."""
    return [c for c in order if c != "seq" or c in rows.columns]


def latest(rows: DataFrame, key: str = "pmid", order: Sequence[str] = CHANGE_ORDER) -> DataFrame:
    """Last write per key wins, whatever order the writes arrived in."""
    return _ranked(rows, key, [F.col(c).desc() for c in _keys(rows, order)])


def earliest(rows: DataFrame, key: str = "pmid", order: Sequence[str] = CHANGE_ORDER) -> DataFrame:
    """First write per key wins."""
    return _ranked(rows, key, [F.col(c).asc() for c in _keys(rows, order)])


def upserts(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("op") == UPSERT)


def quarantined(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("op") == QUARANTINED)


def latest_changes(rows: DataFrame) -> DataFrame:
    """Latest change per id, tombstones kept: what a snapshot must remember."""
    return latest(rows.where(F.col("op").isin(UPSERT, TOMBSTONE)))


def apply_deletes(rows: DataFrame) -> DataFrame:
    """Current rows: the latest change per id, without ids whose latest change deletes them."""
    return upserts(latest_changes(rows))


def _order(rows: DataFrame) -> Column:
    return F.struct(*(rows[c] for c in _keys(rows, CHANGE_ORDER)))


def merge_latest(snapshot: DataFrame, log: DataFrame) -> DataFrame:
    """Latest change per id of a snapshot, which holds one row per id, and a log of any size.

    Only ids and order keys of the log are joined with the snapshot. Spark chooses how by its own
    statistics: it sends them to the snapshot if it finds them small and shuffles otherwise.
    """
    delta = latest_changes(log)
    newest = delta.select("pmid", *_keys(delta, CHANGE_ORDER))
    replaced = (snapshot["pmid"] == newest["pmid"]) & (_order(newest) >= _order(snapshot))
    kept = snapshot.join(newest, replaced, "left_anti")

    known = snapshot.select("pmid", *_keys(snapshot, CHANGE_ORDER))
    known = known.join(newest.select("pmid"), "pmid", "left_semi")
    stale = (delta["pmid"] == known["pmid"]) & (_order(known) > _order(delta))
    return kept.unionByName(delta.join(known, stale, "left_anti"))


def remove_ids(table: DataFrame, ids: DataFrame, key: str = "pmid") -> DataFrame:
    """One-off delete of listed ids from a keyed table."""
    return table.join(ids.select(key).distinct(), key, "left_anti")


def insert_if_absent(
    target: DataFrame, batch: DataFrame, key: str = "pmid", order: Sequence[str] = CHANGE_ORDER
) -> DataFrame:
    """Target, which holds one row per key, plus the first batch row of each key it does not hold.

    One ranking of both together, the target's row first: each side is read once.
    """
    tagged = target.withColumn("_new", F.lit(1)).unionByName(
        batch.select(*target.columns).withColumn("_new", F.lit(2))
    )
    first = [F.col(c).asc() for c in ("_new", *_keys(target, order))]
    return _ranked(tagged, key, first).drop("_new")


def lookup(table: DataFrame, ids: Sequence[str | int] | DataFrame, key: str = "pmid") -> DataFrame:
    """Rows of the given ids. Integers are taken as their text.

    The join carries no broadcast hint: Spark broadcasts the ids only if it finds them small.
    """
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).cast("string").alias(key)).distinct()
        return table.join(wanted, key, "left_semi")
    texts = [str(i) for i in ids]
    if len(texts) <= LITERAL_IDS:
        return table.where(F.col(key).isin(texts))
    listed = table.sparkSession.createDataFrame([(t,) for t in texts], f"{key} STRING")
    return lookup(table, listed, key)
