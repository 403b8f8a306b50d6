"""Compare every named query with its SQL text in DuckDB: ``python tests/compare.py sf0.01 [names]``."""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{0.0 if v == 0 else v:.9g}"
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, date):
        return v.isoformat()
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir: str, run, text: str | None):
    """(ok, message) for one query."""
    df = run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if text is None:
        return True, f"rows only: {len(got)}"
    cur = con.execute(text)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if a != b:
        extra = [r for r in a if r not in set(b)][:3]
        missing = [r for r in b if r not in set(a)][:3]
        return False, f"rows {len(a)} / {len(b)}; spark only {extra}; duckdb only {missing}"
    return True, f"{len(a)} rows"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from oreflow.session import local_session

    folder = f"/root/testdata/{sys.argv[1]}"
    names = sys.argv[2:]
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(folder), oracle_sql()
    bad = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            ok, note = compare(session, con, folder, run, sqls.get(name))
        except Exception as error:  # report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - began:.1f}s {note}", flush=True)
    print("failed:", bad)
