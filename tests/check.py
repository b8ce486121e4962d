"""Compare queries with their oracles: ``python tests/check.py SF_DIR [query ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(frame):
    frame = frame[sorted(frame.columns)]
    rows = frame.astype(object).where(frame.notna(), None)
    key = pd.Series(["\x1f".join(map(repr, row)) for row in rows.itertuples(index=False)])
    return rows.iloc[key.argsort()].reset_index(drop=True)


def differences(got, want):
    """Empty text if the frames hold the same rows."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    got, want = normal(got), normal(want)
    for name in got.columns:
        for g, w in zip(got[name], want[name]):
            if g != w and not (g is None and w is None):
                return f"{name}: {g!r} != {w!r}"
    return ""


def main(sf_dir, names):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
            spent = time.time() - start
            diff = differences(got, con.execute(oracles[name]).df()) if name in oracles else "no oracle"
        except Exception as e:  # noqa: BLE001
            spent, diff = time.time() - start, f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(diff)
        print(f"{'ok ' if not diff else 'BAD'} {name:22} {spent:6.2f}s {len(got) if not diff else diff}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
