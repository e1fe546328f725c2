"""Run registered queries and their SQL and compare all rows.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    return round(value, 6) if isinstance(value, float) else value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, db, query, sql, sf_dir) -> str | None:
    """None if query and SQL agree, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = rows_of(names, cursor.fetchall())
    if got != want:
        extra, missing = got - want, want - got
        return f"{sum(extra.values())} extra, e.g. {list(extra)[:2]}; {sum(missing.values())} missing, e.g. {list(missing)[:2]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    database, sqls = connect(where), oracle_sql()
    for name, fn in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            if name in sqls:
                wrong = difference(session, database, fn, sqls[name], where)
                outcome = "ok" if wrong is None else f"DIFFERS {wrong}"
            else:
                outcome = f"no sql, {fn(session, where).count()} rows"
        except Exception as error:  # report and go on
            outcome = f"FAILED {type(error).__name__} {str(error)[:1500]}"
        print(f"{name:22} {time.time() - began:6.2f}s {outcome}", flush=True)
