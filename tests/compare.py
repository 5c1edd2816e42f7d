"""Run registered queries next to their SQL on DuckDB and compare by value."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def difference(df, con, sql: str) -> str | None:
    """None where both agree, else what differs."""
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    types = {d[0]: str(d[1]) for d in out.description}
    want = _rows(names, out.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    for name, kind in df.dtypes:
        if SPARK_TYPES.get(kind, kind) != types[name] and "array" not in kind:
            return f"type of {name}: {kind} != {types[name]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"first difference\n   {a}\n   {b}"
    return None


if __name__ == "__main__":
    from ledgerline.plans.catalog import all_queries, all_sql
    from ledgerline.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con, sqls = local_session(8), connect(folder), all_sql()
    bad = 0
    for name, fn in all_queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            df = fn(spark, folder)
            if name in sqls:
                problem = difference(df, con, sqls[name])
                note = "ok" if problem is None else problem
                rows = ""
            else:
                rows, note = f"rows={df.count()}", "no sql"
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = note = f"{type(e).__name__}: {str(e)[:600]}"
            rows = ""
        bad += note not in ("ok", "no sql")
        print(f"{name:32s} {time.time() - t:6.2f}s {rows} {note}", flush=True)
    print("bad:", bad)
    sys.exit(bad > 0)
