"""Compare registered queries with their oracle SQL: names, row counts and exact values.

``python -m harness.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(actual: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise a description of the difference."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(actual.columns) != sorted(names):
        return f"columns {sorted(actual.columns)} != {sorted(names)}"
    want = _bag(names, expected.fetchall())
    got = _bag(actual.columns, [tuple(r) for r in actual.collect()])
    if want == got:
        return None
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; "
        f"extra {list((got - want).items())[:2]}; missing {list((want - got).items())[:2]}"
    )


def main(argv: list[str]) -> int:
    from faremill.session import get_session
    from harness import model_sql, oracle, table_sql
    from harness.registry import QUERIES

    ORACLE = oracle.ORACLE | model_sql.ORACLE | table_sql.ORACLE
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(QUERIES)
    spark = get_session("compare", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                verdict = difference(df, connection, ORACLE[name])
            else:
                verdict = None if df.count() >= 0 else "no rows"
        except Exception as error:  # report every query before failing
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += verdict is not None
        kind = "oracle" if name in ORACLE else "rows"
        print(f"{name:26s} {kind:6s} {time.time() - start:6.2f}s {verdict or 'ok'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
