"""Keyed-table and statistics operators on small tables, frequent keys included."""

import random

import pytest
from pyspark.sql import functions as F

from citeflow.operators import ledger as led
from citeflow.operators import stats
from citeflow.operators import tables as tab
from citeflow.schema import CHANGE_ORDER

ROW = "op STRING, pmid STRING, phase INT, file STRING, block BIGINT, ord BIGINT, v INT"


def random_changes(n, hot=0.4, seed=1):
    """Changes in which one id holds a large share of all rows."""
    rng = random.Random(seed)
    return [
        (rng.choice("UUUD"), "hot" if rng.random() < hot else str(rng.randrange(40)),
         rng.randrange(2), f"f{rng.randrange(5)}", 0, i, i)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def rows():
    return random_changes(3000)


def replay(rows, keep_deletes=False):
    state = {}
    for op, pmid, *rest, v in sorted(rows, key=lambda r: r[2:6]):
        if op == "U":
            state[pmid] = v
        else:
            state.pop(pmid, None)
    return state


def as_dict(frame):
    return {r.pmid: r.v for r in frame.collect()}


def test_apply_deletes_equals_serial_replay(spark, rows):
    frame = spark.createDataFrame(rows, ROW)
    assert as_dict(tab.apply_deletes(frame)) == replay(rows)
    shuffled = random.Random(2).sample(rows, len(rows))
    again = spark.createDataFrame(shuffled, ROW).repartition(7)
    assert as_dict(tab.apply_deletes(again)) == replay(rows)


@pytest.mark.parametrize("cut", [0, 40, 1500, 3000])
def test_merge_of_snapshot_and_log_equals_replay(spark, rows, cut):
    mixed = random.Random(5).sample(rows, len(rows))  # the log may be older than the snapshot
    snapshot = tab.latest_changes(spark.createDataFrame(mixed[:cut], ROW))
    merged = tab.merge_latest(snapshot, spark.createDataFrame(mixed[cut:], ROW))
    assert as_dict(tab.upserts(merged)) == replay(rows)
    assert merged.groupBy("pmid").count().where("count > 1").count() == 0


def test_merge_does_not_shuffle_the_snapshot(spark, rows, tmp_path):
    path = str(tmp_path / "snapshot")
    tab.latest_changes(spark.createDataFrame(rows[:2000], ROW)).write.parquet(path)
    # As in a store, the log is a table whose size Spark knows: it decides by that, without a hint.
    spark.createDataFrame(rows[2000:], ROW).write.parquet(str(tmp_path / "log"))
    merged = tab.merge_latest(spark.read.parquet(path), spark.read.parquet(str(tmp_path / "log")))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan.split("Union", 1)[1].split("FileScan", 1)[0]
    assert "Exchange" not in plan.split("FileScan", 1)[0].replace("BroadcastExchange", "")


def test_latest_and_earliest(spark, rows):
    ups = [r for r in rows if r[0] == "U"]
    frame = spark.createDataFrame(ups, ROW)
    ordered = sorted(ups, key=lambda r: r[2:6])
    assert as_dict(tab.latest(frame)) == {r[1]: r[6] for r in ordered}
    assert as_dict(tab.earliest(frame)) == {r[1]: r[6] for r in reversed(ordered)}


def test_insert_if_absent(spark, rows):
    ups = [r for r in rows if r[0] == "U"]
    target = spark.createDataFrame([r for r in ups if r[1] == "hot"][:1], ROW)
    got = as_dict(tab.insert_if_absent(target, spark.createDataFrame(ups, ROW)))
    want = {r[1]: r[6] for r in reversed(sorted(ups, key=lambda r: r[2:6]))}
    want["hot"] = target.first().v
    assert got == want


def test_remove_and_lookup(spark, rows):
    frame = tab.latest(spark.createDataFrame(rows, ROW))
    ids = spark.createDataFrame([("hot",), ("3",), ("3",)], "pmid STRING")
    everything = as_dict(frame)
    assert set(as_dict(tab.remove_ids(frame, ids))) == set(everything) - {"hot", "3"}
    assert set(as_dict(tab.lookup(frame, ids))) == {"hot", "3"}
    assert set(as_dict(tab.lookup(frame, [3, "hot", "none"]))) == {"hot", "3"}
    many = ["hot", *map(str, range(tab.LITERAL_IDS + 5))]
    assert as_dict(tab.lookup(frame, many)) == everything


def test_ledger(spark):
    done = spark.createDataFrame(
        [("a", 0, 0.0, 1), ("a", 7, 2.0, 2), ("b", 3, 1.0, 1)],
        "file STRING, article_cnt INT, duration DOUBLE, run INT",
    )
    rows = led.ledger_rows(done).join(done.select(F.col("file").alias("fn"), "article_cnt", "run"),
                                      ["fn", "article_cnt"])
    current = led.ledger_current(rows)
    assert {(r.fn, r.article_cnt, r.duration) for r in current.collect()} == {
        ("a", 7, 2.0), ("b", 3, 1.0),
    }
    assert {len(r.file_key) for r in current.collect()} == {64}


STATS = "phase INT, file STRING, article_cnt BIGINT, duration DOUBLE, elapsed DOUBLE"


def test_rates(spark):
    frame = spark.createDataFrame(
        [(0, "a", 10, 2.0, 2.0), (1, "b", 5, 0.0, 4.0), (1, "c", 9, 3.0, 8.0)], STATS
    )
    rated = {r.file: (r.rate, r.estimated_rate) for r in stats.file_rates(frame, 10).collect()}
    assert rated == {"a": (5.0, 50.0), "b": (None, None), "c": (3.0, None)}
    assert tuple(stats.total_rate(frame).first()) == (24, 3.0)
    none = frame.where("false")
    assert tuple(stats.total_rate(none).first()) == (None, None)


def test_progress_equals_numbering_every_record(spark):
    rng = random.Random(3)
    files = [(p, f"f{i}", rng.choice([0, 3, 17, 45]), rng.random() * 9, 0.0)
             for p in (0, 1) for i in range(12)]
    got = {
        (r.phase, r.block): (r.file, r.records, round(r.elapsed, 6))
        for r in stats.progress_blocks(spark.createDataFrame(files, STATS), every=10).collect()
    }
    want = {}
    for phase in (0, 1):
        n, spent = 0, 0.0
        for _, file, count, seconds, _ in sorted(f for f in files if f[0] == phase):
            for i in range(1, count + 1):
                if (n + i) % 10 == 0:
                    at = spent + i / count * seconds
                    want[phase, (n + i) // 10] = (file, n + i, round(at, 6))
            n, spent = n + count, spent + seconds
    assert got == want


def test_change_order_is_total(rows):
    assert CHANGE_ORDER == ("phase", "file", "seq", "block", "ord")
    assert len({r[2:6] for r in rows}) == len(rows)
