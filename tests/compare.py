"""Row-for-row comparison of the registered queries with their SQL.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, sf_dir: str, name: str, query, sql: str) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {df.columns} against {names}"
    if got == want:
        return None
    more, less = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; "
        f"extra {list(more)[:3]}; missing {list(less)[:3]}"
    )


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, sql = entry.queries(), entry.oracle_sql()
    spark, con = make_session(), connect(sf_dir)
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, queries[name], sql[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name}: {problem or 'equal'} ({time.time() - start:.1f} s)", flush=True)


if __name__ == "__main__":
    main()
