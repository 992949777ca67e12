"""Run registered queries next to their SQL and compare rows as multisets."""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(root):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{root}/{t}.parquet')")
    return con


def norm(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, float):
        return float(f"{v:.9g}") + 0.0
    if isinstance(v, Decimal):
        return float(f"{float(v):.12g}") + 0.0
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def family(name):
    n = name.lower()
    if "char" in n or n == "string":
        return "text"
    if n.startswith("decimal"):
        return "decimal"
    if n in ("bigint", "integer", "int", "hugeint", "smallint", "tinyint"):
        return "int"
    if n.startswith("timestamp"):
        return "timestamp"
    return n


def compare(spark, con, fn, sql, root):
    """None when equal, else a short description of the first difference."""
    df = fn(spark, root)
    cols = sorted(df.columns)
    ours = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    if sql is None:
        return None, sum(ours.values()), "no oracle"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    rows = rel.fetchall()
    if sorted(names) != cols:
        return f"columns differ: only ours {set(cols) - set(names)}, only oracle " \
               f"{set(names) - set(cols)}", len(rows), ""
    idx = [names.index(c) for c in cols]
    theirs = Counter(tuple(norm(r[i]) for i in idx) for r in rows)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    note = "; ".join(f"{c}: {types[c]} / {kinds[c]}" for c in cols
                     if family(types[c]) != family(kinds[c]))
    if ours == theirs:
        return None, len(rows), note
    a, b = ours - theirs, theirs - ours
    return (f"rows {sum(ours.values())} / {len(rows)}, only ours {sum(a.values())}, only oracle "
            f"{sum(b.values())}\n   cols {cols}\n   ours   {next(iter(a), None)}\n   oracle "
            f"{next(iter(b), None)}"), len(rows), note


def main(argv):
    from procmetrics.plans.registry import ORACLES, QUERIES
    from procmetrics.session import local_session
    import importlib
    import os

    root = os.environ.get("SF", "/root/testdata/sf0.01")
    mods = os.environ.get("MODS", "").split()
    if mods:
        for m in mods:
            importlib.import_module(f"procmetrics.plans.{m}")
    else:
        from procmetrics.plans.catalog import load
        load()
    spark, con = local_session("oracle", 8), connect(root)
    names = [n for n in QUERIES if not argv or any(n.startswith(a) for a in argv)]
    bad = 0
    for n in names:
        t = time.time()
        try:
            diff, rows, note = compare(spark, con, QUERIES[n], ORACLES.get(n), root)
        except Exception as e:  # noqa: BLE001
            diff, rows, note = f"{type(e).__name__}: {str(e)[:600]}", 0, ""
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {n} rows={rows} {time.time() - t:.1f}s {note}"
              + (f"\n   {diff}" if diff else ""), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
