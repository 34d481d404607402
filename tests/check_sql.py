"""Compare registered queries with their SQL: ``python -m tests.check_sql [folder] [name prefix ...]``."""
from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def normal(frame: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return "null"
        if isinstance(x, bool) or type(x).__name__ == "bool_":
            return str(bool(x))
        if hasattr(x, "item"):
            x = x.item()
        if isinstance(x, float):
            return f"{round(x, 6) + 0.0:.6f}"
        if isinstance(x, int):
            return str(x)
        return str(x)

    frame = frame[sorted(frame.columns)]
    columns = [[cell(x) for x in frame[c].astype(object)] for c in frame.columns]
    return sorted(zip(*columns)) if columns else []


def compare(spark, con, name: str, query, sql: str, folder: str) -> str:
    """'' if equal, else what differs."""
    got = query(spark, folder)
    types = dict(got.dtypes)
    got = got.toPandas()
    rel = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in rel.description}
    want = rel.df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    off = {c: (t, want_types[c]) for c, t in types.items() if t in same and same[t] != want_types[c]}
    a, b = normal(got), normal(want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)} {off}"
    if a != b:
        pairs = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(pairs)} rows differ, e.g. {pairs[0]} {off}"
    return f"types {off}" if off else ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from panelwise.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark, con = local_session("8"), connect(folder)
    sqls, bad = oracle_sql(), 0
    for name, query in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, name, query, sqls[name], folder)
            else:
                problem = "" if query(spark, folder).count() > 0 else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem)
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
