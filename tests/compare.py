"""Run registered queries against DuckDB on the given tables and compare them.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

import datetime as dt
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, sf, name, fn, sql):
    df = fn(spark, sf)
    got_names, got = _table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows {len(got)}"
    cur = con.execute(sql)
    want_names, want = _table([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        raise AssertionError(f"columns {got_names} != {want_names}")
    if len(got) != len(want):
        raise AssertionError(f"row count {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        raise AssertionError(f"{len(bad)}/{len(got)} rows differ, first: {bad[0][0]} != {bad[0][1]}")
    kinds = {c: (type(g).__name__, type(w).__name__) for row_g, row_w in zip(got[:50], want[:50])
             for c, g, w in zip(got_names, row_g, row_w) if g is not None and type(g) is not type(w)}
    return f"match {len(got)}" + (f" TYPES {kinds}" if kinds else "") + (" EMPTY" if not got else "")


def main():
    from riskspark.session import local_session
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = local_session(), connect(sf)
    checks, failed = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        t = time.time()
        try:
            msg = compare(spark, con, sf, name, fn, checks.get(name))
        except Exception as e:  # report and go on
            failed.append(name)
            text = str(e) if isinstance(e, AssertionError) else "".join(traceback.format_exception(e))[-1500:]
            msg = "FAIL " + text
        print(f"{name:28s} {time.time() - t:6.2f}s {msg}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
