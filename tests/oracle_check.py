"""Compare registered queries with their SQL on the shared test tables.

Usage: python tests/oracle_check.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from guidewave.functions.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return "NULL"
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(float(value))
    if hasattr(value, "tolist"):
        value = value.tolist()
        if isinstance(value, float):
            return "NULL" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    return str(value)


def rows_of(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted(tuple(canonical(v) for v in row) for row in df.itertuples(index=False, name=None))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session("8")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            got_df = fn(spark, sf_dir)
            types = {f.name: f.dataType.simpleString() for f in got_df.schema.fields}
            got = got_df.toPandas()
            for c, t in types.items():
                if "int" in t and "array" not in t and got[c].dtype.kind == "f":
                    got[c] = got[c].astype("Int64")
        except Exception as exc:
            bad += 1
            print(f"ERROR {name}: {type(exc).__name__} {str(exc)[:900]}", flush=True)
            continue
        spark_s = time.time() - start
        if name not in oracles:
            print(f"rows  {name}: {len(got)} rows {spark_s:.1f}s", flush=True)
            continue
        start = time.time()
        try:
            rel = con.execute(oracles[name])
            want = rel.fetchdf()
        except Exception as exc:
            bad += 1
            print(f"SQLERR {name}: {str(exc)[:900]}", flush=True)
            continue
        sql_s = time.time() - start
        if set(got.columns) != set(want.columns):
            bad += 1
            print(f"COLS  {name}: only spark {sorted(set(got.columns) - set(want.columns))}, only sql {sorted(set(want.columns) - set(got.columns))}", flush=True)
            continue
        a, b = rows_of(got), rows_of(want)
        kinds = {c: (types[c], str(want[c].dtype)) for c in got.columns}
        odd = {c: k for c, k in kinds.items() if ("int" in k[0]) != ("int" in k[1]) and k[0] not in ("string", "boolean") and "array" not in k[0] and not ("float" in k[1] and "int" in k[0])}
        if a == b and len(a):
            print(f"ok    {name}: {len(a)} rows {spark_s:.1f}s sql {sql_s:.1f}s {odd or ''}", flush=True)
        else:
            bad += 1
            diff = [(x, y) for x, y in zip(a, b) if x != y]
            print(f"DIFF  {name}: spark {len(a)} rows, sql {len(b)} rows, {len(diff)} differ {odd or ''}\n   cols {sorted(got.columns)}", flush=True)
            for x, y in diff[:2]:
                print("   spark", x, "\n   sql  ", y)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
