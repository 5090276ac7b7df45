"""Run catalog queries beside their SQL counterparts: python tests/sidebyside.py [sf] [names...]

With NO_BROADCAST=1 no table counts as small, so every join takes the path for large tables.
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dayshape.plans.bindings import TABLES  # noqa: E402

DATA = Path("/root/testdata")


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{sf}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def difference(df, con, sql: str) -> str | None:
    """None if both sides hold the same columns and rows, else what differs first."""
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    mine, theirs = rows_of(df.columns, df.collect()), rows_of(columns, found.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    bad = [
        (m, t)
        for m, t in zip(mine, theirs, strict=True)
        if not all(same(x, y) for x, y in zip(m, t, strict=True))
    ]
    return f"{len(bad)} of {len(mine)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("NO_BROADCAST"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    con = connect(sf)
    failed = []
    for name in names:
        started = time.perf_counter()
        try:
            df = queries()[name](spark, f"{DATA}/{sf}")
            sql = oracle_sql().get(name)
            if sql is None:
                note = f"no SQL, {df.count()} rows"
            else:
                note = difference(df, con, sql)
                if note:
                    failed.append(name)
                note = note or "same"
        except Exception as error:  # noqa: BLE001
            failed.append(name)
            note = f"{type(error).__name__}: {str(error)[:300]}"
        print(f"{name:24s} {time.perf_counter() - started:6.2f}s {note}", flush=True)
    print("FAILED", failed)


if __name__ == "__main__":
    main()
