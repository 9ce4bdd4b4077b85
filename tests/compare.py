"""Compare registered queries with their SQL: same columns, same rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else (int(value) if value == int(value) and abs(value) < 1e15 else value)
    if hasattr(value, "item"):
        return plain(value.item())
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


TIMES = {"spark": 0.0}


def compare(spark, con, sf_dir, build, sql):
    """Message on a difference, else None; and the number of rows."""
    start = time.time()
    df = build(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    TIMES["spark"] = time.time() - start
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}", len(mine[1])
    if mine[1] != theirs[1]:
        lost = [r for r in theirs[1] if r not in set(mine[1])][:2]
        extra = [r for r in mine[1] if r not in set(theirs[1])][:2]
        return f"rows {len(mine[1])} / {len(theirs[1])}\n   spark: {str(extra)[:700]}\n   sql:   {str(lost)[:700]}", len(mine[1])
    return None, len(mine[1])


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tests.conftest import make_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = make_session()
    con = connect(sf_dir)
    queries, checks = entry.queries(), entry.oracle_sql()
    bad = []
    for name, build in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start, TIMES["spark"] = time.time(), 0.0
        try:
            if name in checks:
                message, n = compare(spark, con, sf_dir, build, checks[name])
            else:
                message, n = None, build(spark, sf_dir).count()
        except Exception as error:  # noqa: BLE001
            message, n = f"{type(error).__name__}: {str(error)[:1500]}", 0
        state = "ok  " if message is None else "DIFF"
        note = "" if name in checks else "  (rows only)"
        print(f"{state} {name:34s} {n:7d} rows {TIMES["spark"]:6.1f}s of {time.time() - start:6.1f}s{note}", flush=True)
        if message:
            bad.append(name)
            print("   " + message, flush=True)
    print(f"{len(bad)} bad: {bad}")


if __name__ == "__main__":
    main()
