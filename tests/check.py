"""Compare registered queries with their SQL: ``python -m tests.check [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(frame, connection, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    mine = rows_of(frame.columns, frame.collect())
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [
            (c, x, y) for c, x, y in zip(sorted(names), a, b, strict=True) if x != y
        ]
        return f"{len(wrong)} of {len(mine)} rows differ, first in {cells[:4]}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from meterflow.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:]
    spark = local_session(8)
    connection = database(sf_dir)
    sqls = entry.oracle_sql()
    bad = []
    for name, query in entry.queries().items():
        if (wanted and name not in wanted) or (not wanted and name not in sqls):
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in sqls:
                found = compare(frame, connection, sqls[name])
                note = f"{frame.count()} rows"
            else:
                found, note = None, f"{len(frame.collect())} rows, no SQL"
        except Exception as error:  # report every query, then fail
            found, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.1f}s {note} {found or ''}", flush=True)
        if found:
            bad.append(name)
    print("missing SQL:", sorted(set(entry.queries()) - set(sqls)))
    print("orphan SQL:", sorted(set(sqls) - set(entry.queries())))
    print("bad:", bad)


if __name__ == "__main__":
    main()
