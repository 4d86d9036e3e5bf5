"""Compare queries with their SQL counterparts, value by value.

``python tests/oracle_check.py <folder> [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tilldeck.plans.catalog import GIVEN_TABLES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in GIVEN_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _value(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value if value is None or isinstance(value, bool) else str(value)


def compare(spark, connection, query, sql: str, folder: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, folder)
    order = sorted(df.columns)
    ours = Counter(tuple(_value(row[c]) for c in order) for row in df.collect())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != order:
        return f"columns {order} != {sorted(names)}"
    places = [names.index(c) for c in order]
    theirs = Counter(tuple(_value(row[i]) for i in places) for row in result.fetchall())
    kinds = dict(zip(names, (str(d[1]) for d in result.description)))
    for name, kind in df.dtypes:
        wanted = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
        if wanted.get(kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    if ours != theirs:
        extra, lacking = ours - theirs, theirs - ours
        return (
            f"{order}\n  rows {sum(ours.values())} / {sum(theirs.values())}; "
            f"only ours {sum(extra.values())}: {list(extra)[:2]}\n  only theirs: {list(lacking)[:2]}"
        )
    return None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from tilldeck.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle, queries = connect(folder), entry.oracle_sql(), entry.queries()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracle:
                verdict = compare(spark, connection, queries[name], oracle[name], folder)
            else:
                verdict = None if queries[name](spark, folder).collect() else "no rows"
        except Exception as error:  # noqa: BLE001 - reported and counted
            verdict = f"{type(error).__name__}: {str(error)[:500]}"
        bad += verdict is not None
        label = "rows only" if name not in oracle else "ok"
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict or label}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
