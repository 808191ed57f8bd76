"""Compare every query with its SQL: python tests/check_oracles.py [sf] [names…]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return v + 0.0
    return v


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str, make, sql: str | None) -> tuple[str, float]:
    start = time.time()
    df = make(spark, sf_dir)
    got_cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if sql is None:
        return f"rows only ({len(got)})", took
    rel = con.execute(sql)
    want_cols, want = canonical([d[0] for d in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"MISMATCH columns {got_cols} / {want_cols}", took
    if len(got) != len(want):
        return f"MISMATCH rows {len(got)} / {len(want)}", took
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    if bad:
        return f"MISMATCH values {len(bad)} of {len(got)}: {bad[0]}", took
    return f"ok ({len(got)})", took


def main() -> None:
    import __spark_entry__ as e
    from gaugeflow.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), database(sf_dir)
    names = sys.argv[2:] or list(e.queries())
    failed = 0
    for n in names:
        try:
            result, took = compare(spark, con, sf_dir, n, e.queries()[n], e.oracle_sql().get(n))
        except Exception as x:  # report and go on with the next query
            result, took = f"ERROR {type(x).__name__}: {str(x)[:600]}", 0.0
        failed += not result.startswith(("ok", "rows"))
        print(f"{n:20s} {took:6.2f}s {result}", flush=True)
    print(f"{len(names)} queries, {failed} failed")


if __name__ == "__main__":
    main()
