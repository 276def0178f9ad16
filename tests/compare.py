"""Compare a registered query with its SQL on the same tables.

Run as a script for one scale: python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'").fetchall()
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, f"{value:.6f}" if value != 0 else f"{0.0:.6f}")
    if hasattr(value, "isoformat"):
        return (4, value.replace(tzinfo=None).isoformat())
    return (5, str(value)) if isinstance(value, str) else (3, str(value))


def normal(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else a short description."""
    frame = query(spark, sf_dir)
    ours = [tuple(r) for r in frame.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    a, b = normal(frame.columns, ours), normal(names, theirs)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}"
    return None


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from tidewright.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8, driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or queries:
        start = time.perf_counter()
        try:
            if name in sql:
                con = connect(sf_dir)
                verdict = difference(spark, con, name, queries[name], sql[name], sf_dir)
                rows = ""
            else:
                verdict = None
                rows = f"rows only: {queries[name](spark, sf_dir).count()}"
        except Exception as exc:  # report and go on with the next query
            verdict = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += verdict is not None
        took = time.perf_counter() - start
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {took:.1f}s {verdict or rows}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
