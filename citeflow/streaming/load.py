"""Incremental load with resume: each run takes the files that arrived since the last one."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citeflow.plans.store import CitationStore
from citeflow.schema import ARTICLE
from citeflow.sources.records import NameRule, clocked, observed, relative_to, split_records, stream_chunks


def stream_load(
    store: CitationStore, data_dir: str, checkpoint: str, stream: str = "files",
    files_per_batch: int = 1000, store_raw: bool = False, name: NameRule | None = None,
    kind: str = ARTICLE, choose: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start a load of all new files of a folder; it ends when they are done.

    The checkpoint remembers the files taken. Batches are named by the stream's own id, which it
    keeps in its checkpoint, so streams never share a name; a batch that is retried after it was
    finished is skipped. Files that are in the ledger already are left out, as in a batch load.
    ``files_per_batch`` should give every executor core a file; ``kind`` and ``choose`` are as in
    a batch load. A damaged file does not stop the stream: its neighbours load, it gets no ledger
    row, and a batch load takes it once it is repaired (the stream has seen its name).
    """
    rule = name or relative_to(data_dir)
    chunks = stream_chunks(store.spark, data_dir, files_per_batch, kind)

    def write(batch: DataFrame, epoch: int) -> None:
        kept = store.spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value
        name = f"stream-{stream}-{json.loads(kept)['id']}-{epoch:09d}"
        done = store.ledger().select(F.col("fn").alias("file"))
        chunks, seen = observed(clocked(batch), rule, kind)
        records = split_records(chunks, rule, kind).join(done, "file", "left_anti")
        store.write_batch(name, records, store_raw=store_raw, choose=choose, seen=seen)

    writer = chunks.writeStream.foreachBatch(write).queryName(f"load-{stream}")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
