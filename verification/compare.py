"""Run queries on Spark and their SQL on DuckDB and compare whole results."""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize() + 0)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _rows(names: list[str], rows: list) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, name: str, query, sql: str, folder: str) -> str:
    """'' when columns and rows agree, otherwise what differs."""
    df = query(spark, folder)
    ours = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = _rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours != theirs:
        return (f"{sum(ours.values())} / {sum(theirs.values())} rows, only Spark "
                f"{list((ours - theirs).items())[:3]}, only SQL {list((theirs - ours).items())[:3]}")
    return ""


def main(folder: str, only: list[str]) -> int:
    from knownwhen.session import local_session
    from verification.oracles import ORACLES
    from verification.queries import QUERIES

    spark, con, bad = local_session(), connect(folder), 0
    for name in only or QUERIES:
        start = time.time()
        try:
            said = (compare(spark, con, name, QUERIES[name], ORACLES[name], folder)
                    if name in ORACLES else "no SQL")
        except Exception as problem:  # noqa: BLE001 - report and go on
            said = f"error {str(problem)[:700]}"
        bad += bool(said)
        print(f"{'ok  ' if not said else 'DIFF'} {name:24s} {time.time() - start:6.2f} {said}",
              flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
