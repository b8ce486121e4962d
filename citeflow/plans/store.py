"""A keyed document table on plain Parquet: change log, snapshot and ledger.

Below ``root``:

* ``settings``          one row: the number of hash buckets, fixed when the store is created;
* ``changes/batch=B``   the changes of one load; only an unfinished batch is ever overwritten;
* ``ledger/batch=B``    the files of that load; written last, so it is also what makes the
  batch count: changes of a batch without ledger rows are not read. Changes that come from no
  file (deletes, inserts, reprocessing) have one row with an empty file name;
* ``snapshots/snapshot=M``  latest change per id, hash-bucketed, with tombstones and ordering
  keys kept so that a late old file cannot bring back a deleted record;
* ``pointers``          one row per finished snapshot, naming the batches it contains.

No folder is overwritten by a job that reads it. One batch has one writer; different batches
may be written at the same time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeflow.operators.ledger import ledger_current, ledger_rows, list_files, pending_files
from citeflow.operators.tables import (
    QUARANTINED, SKIPPED, TOMBSTONE, UPSERT, changes, earliest, latest_changes, lookup,
    merge_latest, quarantined, upserts,
)
from citeflow.operators.stats import of_ledger
from citeflow.schema import ARTICLE, CHANGE, DELETE, DOC, LEDGER, SETTINGS
from citeflow.sources.records import NameRule, damaged, phase_of, read_checked, relative_to, silent

# Gzip bytes to a partition when records are spread: some hundred megabytes of XML.
SPREAD_BYTES = 16 << 20

_LOADED_AT = "loaded_at"
_LEDGER_ROW = f"{LEDGER}, phase INT, elapsed DOUBLE, {_LOADED_AT} TIMESTAMP, seq BIGINT"
PROGRESS = "seq BIGINT, files BIGINT, chunks BIGINT, article_cnt BIGINT, damaged BIGINT, seconds DOUBLE, elapsed DOUBLE"
# A session may ask for dynamic overwriting, which would keep what a reset must remove.
_STATIC = {"partitionOverwriteMode": "static"}
_POINTER = "snapshot BIGINT, batches ARRAY<STRING>"


def _new_batch(what: str) -> str:
    return f"{what}-{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"


def _spread(lengths: Sequence[int], cores: int) -> int | None:
    """Partitions to shuffle records over before parsing; None if the files divide evenly.

    Only worth its shuffle where one file would keep a core busy for more than twice its share.
    """
    total = sum(lengths)
    if total <= SPREAD_BYTES or max(lengths) * cores <= 2 * total:
        return None
    return max(cores, -(-total // SPREAD_BYTES))


class CitationStore:
    def __init__(self, spark: SparkSession, root: str):
        """Open a store that exists."""
        self.spark = spark
        self.root = root.rstrip("/")
        found = self._settings()
        if found is None:
            raise FileNotFoundError(f"no store at {self.root}; use CitationStore.create")
        self.buckets = found

    @classmethod
    def create(cls, spark: SparkSession, root: str, buckets: int | None = None) -> CitationStore:
        """Open a store; create it, with 64 buckets unless told otherwise, if there is none.

        An existing store keeps its tables and its buckets; asking for another number fails.
        """
        store = cls.__new__(cls)
        store.spark, store.root = spark, root.rstrip("/")
        found = store._settings()
        if found is not None and buckets not in (None, found):
            raise ValueError(f"the store at {store.root} has {found} buckets")
        store.buckets = found or buckets or 64
        if found is None:
            store.reset()
            settings = spark.createDataFrame([(store.buckets,)], SETTINGS)
            settings.coalesce(1).write.mode("overwrite").parquet(store._path("settings"))
        return store

    def _settings(self) -> int | None:
        """Buckets of the store, None if there is no store."""
        try:
            row = self.spark.read.schema(SETTINGS).parquet(self._path("settings")).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return row.buckets if row else None

    def _path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    # Tables -------------------------------------------------------------------------------

    def reset(self) -> None:
        """Empty all tables, keeping their schemas. Streams need new checkpoints afterwards."""
        for table, schema in (("ledger", _LEDGER_ROW), ("changes", CHANGE), ("damaged", "file STRING"),
                              ("progress", f"{PROGRESS}, finished_at TIMESTAMP")):
            empty = self.spark.createDataFrame([], f"{schema}, batch STRING")
            empty.write.options(**_STATIC).mode("overwrite").partitionBy("batch").parquet(
                self._path(table)
            )
        for table, schema in (("pointers", _POINTER), ("snapshots", f"{CHANGE}, bucket INT")):
            empty = self.spark.createDataFrame([], schema)
            empty.write.options(**_STATIC).mode("overwrite").parquet(self._path(table))

    def reset_ledger(self) -> None:
        """Forget which files were processed, keeping the documents: a row without a file name
        voids the ledger rows before it."""
        self._note(_new_batch("reset"), None, self._next_seq())

    def _note(self, batch: str, fn: str | None, seq: int) -> None:
        """A ledger row that belongs to no file."""
        row = self.spark.range(1).select(
            F.lit(fn).cast("STRING").alias("file_key"), F.lit(fn).cast("STRING").alias("fn"),
            F.lit(0).cast("BIGINT").alias("article_cnt"), F.lit(0.0).alias("duration"),
            F.current_timestamp().alias(_LOADED_AT), F.lit(seq).cast("BIGINT").alias("seq"),
        )
        row.coalesce(1).write.parquet(self._path("ledger", f"batch={batch}"))

    def _ledger_log(self) -> DataFrame:
        return self.spark.read.schema(f"{_LEDGER_ROW}, batch STRING").parquet(self._path("ledger"))

    def ledger(self) -> DataFrame:
        """Processed files: the last entry of each since the ledger was last reset."""
        log = self._ledger_log().drop("batch")
        void_to = log.where(F.col("fn").isNull()).agg(F.max("seq")).first()[0]
        rows = log.where(F.col("fn") != "")
        if void_to is not None:
            rows = rows.where(F.col("seq") > F.lit(void_to))
        return ledger_current(rows.drop(_LOADED_AT), "seq")

    def file_stats(self) -> DataFrame:
        """Counts and times of the processed files, for the functions of ``operators.stats``.

        ``elapsed`` is the time of all loads since the last reset up to the file's own.
        """
        return of_ledger(self.ledger())

    def _next_seq(self) -> int:
        """Number of the next load: above all finished ones."""
        return (self._ledger_log().agg(F.max("seq")).first()[0] or 0) + 1

    def _committed(self) -> set[str]:
        """Names of the finished batches: one per load, not per file or record."""
        return {r.batch for r in self._ledger_log().select("batch").distinct().collect()}

    def _pointer(self) -> tuple[int, set[str]]:
        rows = self.spark.read.schema(_POINTER).parquet(self._path("pointers"))
        last = rows.orderBy(F.desc("snapshot")).take(1)
        return (last[0].snapshot, set(last[0].batches)) if last else (0, set())

    def _snapshot(self, number: int) -> DataFrame:
        path = self._path("snapshots", f"snapshot={number}")
        return self.spark.read.schema(f"{CHANGE}, bucket INT").parquet(path)

    def _damaged(self) -> DataFrame:
        """``file, batch`` of files that ended too early, as the loads that read them found."""
        try:
            return self.spark.read.schema("file STRING, batch STRING").parquet(self._path("damaged"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], "file STRING, batch STRING")

    def _log(self, batches: set[str]) -> DataFrame:
        """Changes of the batches, without those of damaged files (few: one row each)."""
        rows = self.spark.read.schema(f"{CHANGE}, batch STRING").parquet(self._path("changes"))
        rows = rows.where(F.col("batch").isin(sorted(batches)))
        bad = [(r.batch, r.file) for r in self._damaged().collect()]
        if bad:
            pair = F.struct(F.col("batch"), F.col("file"))
            rows = rows.where(~pair.isin([F.struct(F.lit(b), F.lit(f)) for b, f in bad]))
        return rows

    def bad_files(self) -> DataFrame:
        """``file, batch``: damaged files that no load has taken whole since, with the last batch
        that found them so. A batch of damaged files alone writes no ledger row, but says so here."""
        found = self._damaged().groupBy("file").agg(F.max("batch").alias("batch"))
        return found.join(self.ledger().select(F.col("fn").alias("file")), "file", "left_anti")

    def _bucket(self, pmid: Column) -> Column:
        return F.pmod(F.xxhash64(pmid), F.lit(self.buckets)).cast("int")

    def _buckets(self, ids: Sequence[str] | DataFrame) -> list[int]:
        """Buckets of ids, however many those are: no more than the store has."""
        if not isinstance(ids, DataFrame):
            ids = self.spark.createDataFrame([(i,) for i in ids], "pmid STRING")
        found = ids.select(self._bucket(F.col("pmid")).alias("bucket")).distinct()
        return sorted(r.bucket for r in found.collect())

    def _latest(self, ids: Sequence[str] | DataFrame | None = None) -> DataFrame:
        """Latest change per id, tombstones included."""
        number, included = self._pointer()
        newer = self._committed() - included
        log = self._log(newer).drop("batch")
        if ids is not None:
            log = lookup(log, ids)
        if not number:
            return latest_changes(log)
        snapshot = self._snapshot(number)
        if ids is not None:
            snapshot = lookup(snapshot.where(F.col("bucket").isin(self._buckets(ids))), ids)
        snapshot = snapshot.drop("bucket")
        if not newer:
            return snapshot
        return merge_latest(snapshot, log)

    def _current(self, ids: Sequence[str] | DataFrame | None = None) -> DataFrame:
        return upserts(self._latest(ids))

    def documents(self) -> DataFrame:
        """Current documents, one per id."""
        return self._current().select("doc.*")

    def raw(self) -> DataFrame:
        """Current raw records; empty unless loads were told to store them."""
        rows = self._current().where(F.col("raw_xml").isNotNull())
        return rows.select("pmid", "file", "phase", "block", "ord", "kind", "raw_xml")

    def _select(self, ids: Sequence[str | int] | DataFrame) -> DataFrame:
        if isinstance(ids, DataFrame):
            return self._current(ids.select(F.col(ids.columns[0]).cast("string").alias("pmid")))
        return self._current([str(i) for i in ids])

    def lookup(self, ids: Sequence[str | int] | DataFrame) -> DataFrame:
        """Documents by id; reads the snapshot buckets of the ids only."""
        return self._select(ids).select("doc.*")

    def lookup_raw(self, ids: Sequence[str | int] | DataFrame) -> DataFrame:
        return self._select(ids).select("pmid", "file", "raw_xml")

    def bad_records(self) -> DataFrame:
        """Quarantined records of all loads."""
        rows = self._log(self._committed())
        return quarantined(rows).select("batch", "file", "kind", "error", "raw_xml")

    def unhandled(self) -> DataFrame:
        """Elements of unhandled kinds, by file."""
        rows = self._log(self._committed()).where(F.col("op") == SKIPPED)
        return rows.groupBy("file", "kind").agg(F.count("*").alias("records"))

    # Writes -------------------------------------------------------------------------------

    def write_batch(
        self, batch: str, records: DataFrame, files: DataFrame | None = None,
        store_raw: bool = False, choose: Mapping[str, str] | None = None, seen: Observation | None = None,
        listed: Sequence[str] = (),
    ) -> None:
        """Write the changes of scanned records, then the ledger rows that commit them.

        ``files`` lists files that belong in the ledger even if they hold no record. A file's
        duration is what the tasks that read it spent on it, from clock readings the scan took
        (:func:`~citeflow.sources.records.clocked`); without them, its share of the batch by records. A batch
        that is already finished is left as it is: a stream may offer one again after a failure.
        ``seen`` observes the scan (:func:`~citeflow.sources.records.read_checked`): files that it
        finds damaged get no ledger row, so a later load takes them again, and their changes never
        count. ``listed`` names the files of the load: one of them that gives no text at all (an
        empty or cut file, or an empty gzip stream) is damaged too.
        """
        if self._ledger_log().where(F.col("batch") == batch).take(1):
            return
        start, seq = time.monotonic(), self._next_seq()
        spent = self.ledger().agg(F.max("elapsed")).first()[0] or 0.0
        path = self._path("changes", f"batch={batch}")
        found = changes(records, store_raw=store_raw, seq=seq, choose=choose)
        found.write.options(**_STATIC).mode("overwrite").parquet(path)
        seconds = time.monotonic() - start
        written = self.spark.read.schema(f"{CHANGE}, read_ns BIGINT").parquet(path)
        bad: list[str] = []
        if seen is not None:
            unread = silent(seen, listed)
            if unread:
                gave = written.where(F.col("file").isin(unread)).select("file").distinct().collect()
                unread = sorted(set(unread) - {r.file for r in gave})
            bad = damaged(seen, unread)
        if bad:
            self.spark.createDataFrame([(f,) for f in bad], "file STRING").coalesce(1).write.mode("overwrite") \
                .parquet(self._path("damaged", f"batch={batch}"))

        articles = F.count_if(F.col("op").isin(UPSERT, QUARANTINED))
        # A task's clock readings of a file part span all its rows but the last: scaled by n / (n - 1).
        n = F.count("read_ns")
        span = (F.max("read_ns") - F.min("read_ns")) / 1e9 * n / (n - 1)
        parts = written.groupBy("file", "block").agg(articles.alias("article_cnt"), F.when(n > 1, span).alias("spent"))
        counts = parts.groupBy("file").agg(F.sum("article_cnt").alias("article_cnt"), F.sum("spent").alias("spent"))
        if files is not None:
            counts = files.select("file").join(counts, "file", "left")
        counts = counts.where(~F.col("file").isin(bad))
        counts = counts.select("file", F.coalesce("article_cnt", F.lit(0)).alias("article_cnt"), "spent")
        total, taken = counts.agg(F.sum("article_cnt"), F.count(F.lit(1))).first()
        per_record = seconds / total if total else 0.0
        # Measured where the scan read a clock; otherwise the file's share of the batch, by records.
        share = F.col("article_cnt") * F.lit(per_record)
        stats = counts.withColumn("duration", F.coalesce("spent", share)).drop("spent")
        rows = ledger_rows(stats).withColumns({
            "phase": phase_of(F.col("fn")), "elapsed": F.lit(spent + seconds),
            _LOADED_AT: F.current_timestamp(), "seq": F.lit(seq).cast("bigint"),
        })
        rows.coalesce(1).write.options(**_STATIC).mode("overwrite").parquet(self._path("ledger", f"batch={batch}"))
        # What the batch did, from figures its own jobs gave: no further pass over the data.
        chunks = seen.get["chunks"] if seen is not None else None
        self.spark.createDataFrame(
            [(seq, taken, chunks, total or 0, len(bad), seconds, spent + seconds)],
            PROGRESS,
        ).withColumn("finished_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(
            self._path("progress", f"batch={batch}"))

    def progress(self) -> DataFrame:
        """One row per finished batch, load or stream: files taken, chunks read, articles,
        damaged files, seconds and the elapsed time of all loads until then."""
        try:
            return self.spark.read.schema(f"{PROGRESS}, finished_at TIMESTAMP, batch STRING").parquet(
                self._path("progress"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{PROGRESS}, finished_at TIMESTAMP, batch STRING")

    def load(
        self, data_dir: str, phase: int | None = None, store_raw: bool = False,
        name: NameRule | None = None, kind: str = ARTICLE, choose: Mapping[str, str] | None = None,
    ) -> int:
        """Load the files of a folder that are not in the ledger; returns how many there were.

        ``kind`` is the commonest record of the files, ``choose`` other rules for fields as in
        :func:`~citeflow.operators.tables.changes`.
        ``phase`` restricts the load to the baseline (0) or the updates (1). Both may run in one
        job and in any order: each change carries its place in the total order.
        """
        name = name or relative_to(data_dir)
        listed = list_files(self.spark, data_dir, name)
        if phase is not None:
            listed = listed.where(F.col("phase") == phase)
        # File names only; the driver lists them for the scan in any case.
        todo = pending_files(listed, self.ledger().select("fn")).collect()
        if not todo:
            return 0
        files = self.spark.createDataFrame([(r.file,) for r in todo], "file STRING")
        spread = _spread([r.length for r in todo], self.spark.sparkContext.defaultParallelism)
        records, seen = read_checked(self.spark, [r.path for r in todo], name, kind, spread)
        self.write_batch(_new_batch("load"), records, files.distinct(), store_raw, choose, seen,
                         [r.file for r in todo])
        return len(todo)

    def _apply(self, what: str, found: DataFrame, seq: int) -> None:
        """Write changes that come from no file, then the ledger row that commits them."""
        batch = _new_batch(what)
        found.write.parquet(self._path("changes", f"batch={batch}"))
        self._note(batch, "", seq)

    def delete(self, ids: Sequence[str | int] | DataFrame) -> None:
        """Delete documents by id, until a later file or a reload of their own states them again."""
        seq = self._next_seq()
        gone = self._select(ids).select(
            F.lit(TOMBSTONE).alias("op"), "pmid", "phase", "file",
            F.lit(seq).cast("bigint").alias("seq"), "block", "ord", F.lit(DELETE).alias("kind"),
        )
        self._apply("delete", gone, seq)

    def insert_absent(self, docs: DataFrame) -> None:
        """Insert documents, such as those read from JSON, whose ids the store does not hold.

        Of several documents with an id the first by source file, then title is taken; documents
        without an id cannot be. Any file that states the id replaces it, whatever its name.
        """
        seq = self._next_seq()
        shape = T.StructType.fromDDL(DOC)
        doc = F.struct(*(
            (F.col(f.name) if f.name in docs.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in shape
        ))
        rows = docs.where(F.col("pmid").isNotNull()).select(
            "pmid", F.coalesce(doc["source_file"], F.lit("")).alias("source_file"),
            doc["title"].alias("title"), F.xxhash64(F.to_json(doc)).alias("code"), doc.alias("doc"),
        )
        held = self._latest().select("pmid", F.col("op").alias("held"), "phase", "file")
        fresh = earliest(rows, "pmid", ("source_file", "title", "code")).join(held, "pmid", "left")
        found = fresh.where(F.coalesce(F.col("held") != UPSERT, F.lit(True))).select(
            F.lit(UPSERT).alias("op"), "pmid",
            # On top of the tombstone of a deleted id, else before all files.
            F.coalesce("phase", F.lit(-1)).alias("phase"), F.coalesce("file", "source_file").alias("file"),
            F.lit(seq).cast("bigint").alias("seq"), F.lit(0).cast("bigint").alias("block"),
            F.lit(0).cast("bigint").alias("ord"), F.lit(ARTICLE).alias("kind"), "doc",
        )
        self._apply("insert", found, seq)

    def reprocess(self, choose: Mapping[str, str] | None = None) -> None:
        """Parse the stored raw records of all current documents again, without the files."""
        seq = self._next_seq()
        self._apply("reprocess", changes(self.raw(), store_raw=True, seq=seq, choose=choose), seq)

    def compact(self) -> None:
        """Fold all finished batches into a new snapshot; the pointer row makes it current."""
        number, included = self._pointer()
        committed = self._committed()
        if committed <= included:
            return
        bucketed = self._latest().withColumn("bucket", self._bucket(F.col("pmid")))
        ordered = bucketed.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "pmid")
        path = self._path("snapshots", f"snapshot={number + 1}")
        ordered.write.options(**_STATIC).mode("overwrite").partitionBy("bucket").parquet(path)
        pointer = self.spark.createDataFrame([(number + 1, sorted(committed))], _POINTER)
        pointer.coalesce(1).write.mode("append").parquet(self._path("pointers"))
