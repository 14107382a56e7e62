"""Run registered queries beside their SQL and compare rows.

``python tests/compare.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=_key)


def compare(con, sql: str, df) -> str | None:
    """None if both agree, else what differs."""
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]).upper() for d in result.description}
    expected = result.fetchall()
    got = df.collect()
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if same.get(kind) != kinds[name]:
            print(f"    note: {name} is {kind}, SQL has {kinds[name]}")
    for a, b in zip(rows_of(df.columns, got), rows_of(expected_columns, expected)):
        if a != b and not _close(a, b):
            return f"row {str(a)[:600]}\n    !=  {str(b)[:600]}"
    return None


def _close(a, b) -> bool:
    return all(x == y for x, y in zip(a, b))


def main() -> None:
    import __spark_entry__ as entry
    from tagtide.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(8), connect(sf_dir)
    bad = []
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            problem = compare(con, sql, df) if sql else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        if problem and not problem.startswith("no SQL"):
            bad.append(name)
        print(f"{'ok ' if not problem else '-- '}{name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - len(bad)} of {len(names)} fine; bad: {bad}")


if __name__ == "__main__":
    main()
