"""Run registered queries beside their SQL and compare the rows.

    python tests/compare.py [--dir FOLDER] [name ...]
"""

from __future__ import annotations

import argparse
import importlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool) or v is None:
        return str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def check(spark, con, name, fn, sql, folder) -> tuple[bool, str]:
    start = time.time()
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return True, f"rows only: {len(got)} rows, {took:.1f}s"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    gc, g = rows_of(df.columns, got)
    wc, w = rows_of(names, want)
    if gc != wc:
        return False, f"columns {gc} != {wc}"
    if g != w:
        extra = [r for r in g if r not in set(w)][:3]
        lost = [r for r in w if r not in set(g)][:3]
        return False, f"{len(g)} vs {len(w)} rows; {gc}\n   spark only {extra}\n   sql only   {lost}"
    kinds = [(str(d[1]), f.dataType.simpleString()) for d, f in zip(cur.description, df.schema.fields) if d[0] == f.name]
    return True, f"{len(g)} rows, {took:.1f}s {sorted(set(kinds))}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("--module")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from millwright.session import get_session

    spark = get_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    if args.module:
        from millwright.catalog import registry

        for m in args.module.split(","):
            importlib.import_module(f"millwright.catalog.{m}")
        queries, oracles = registry.QUERIES, registry.ORACLES
    else:
        from millwright.catalog import load

        queries, oracles = load()
    con = connect(args.dir)
    bad = 0
    for name in args.names or queries:
        try:
            ok, note = check(spark, con, name, queries[name], oracles.get(name), args.dir)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:9000]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{bad} failures")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
