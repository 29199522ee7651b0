"""Run registered queries and their SQL side by side: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf: str):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return db


def cell(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def key(row):
    return tuple("" if v is None else v for v in row)


def normal(frame):
    columns = sorted(frame.columns)
    data = [tuple(cell(v) for v in r) for r in frame[columns].itertuples(index=False, name=None)]
    return columns, sorted(data, key=key)


def compare(spark, db, sf, name, queries, oracles):
    """None when equal, else a message."""
    got = queries[name](spark, sf).toPandas()
    if name not in oracles:
        return None if len(got) else "no rows"
    want = db.execute(oracles[name]).df()
    for c in set(want.columns) & set(got.columns):
        if want[c].dtype == "Int64" and got[c].dtype == "float64":  # whole numbers with nulls
            want[c] = want[c].astype("float64")
    gc, g = normal(got)
    wc, w = normal(want)
    if gc != wc:
        return f"columns {gc} and {wc}"
    if len(g) != len(w):
        return f"{len(g)} rows and {len(w)}"
    types = {c: (str(got[c].dtype), str(want[c].dtype)) for c in gc if got[c].dtype != want[c].dtype}
    bad = [(a, b) for a, b in zip(g, w) if a != b]
    if bad:
        return f"{len(bad)} of {len(g)} rows differ, first {bad[0]}"
    if types and len(got):
        return f"types {types}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from affinity.session import get_session

    sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.001'}"
    names = sys.argv[2:] or list(entry.queries())
    spark = get_session(
        "check", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duck(sf)
    failed = 0
    for name in names:
        t = time.time()
        try:
            message = compare(spark, db, sf, name, entry.queries(), entry.oracle_sql())
        except Exception as e:  # report and go on with the next query
            message = f"{type(e).__name__}: {str(e)[:700]}"
        failed += message is not None
        kind = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'FAIL' if message else 'ok  '} {kind:4} {name:24} {time.time() - t:6.1f}s {message or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} passed")
