"""Run registered queries against their SQL oracles: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def mismatch(spark_df, con, sql: str) -> str | None:
    """None when columns, row count and every value (with its type) agree."""
    cur = con.execute(sql)
    want_cols, want = table([d[0] for d in cur.description], cur.fetchall())
    cols, got = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    bad = [(a, b) for a, b in zip(got, want) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; first difference {bad[:1]}"
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. spark {dict(zip(cols, bad[0][0]))} oracle {bad[0][1]}"
    return None


def main() -> int:
    from tidemark.registry.oracles import ORACLES
    from tidemark.registry.queries import QUERIES
    from tidemark.session import local_session

    spark, sf = local_session(int(os.environ.get("BENCH_CPUS", "8"))), sys.argv[1]
    con, failed = oracle_connection(sf), 0
    for name in sys.argv[2:] or QUERIES:
        t = time.time()
        if name not in ORACLES:
            n = QUERIES[name](spark, sf).count()
            print(f"ROWS  {name:28s} {n} {time.time() - t:.2f}s", flush=True)
            continue
        try:
            why = mismatch(QUERIES[name](spark, sf), con, ORACLES[name])
        except Exception as e:  # report every query, then fail
            why = str(e)[:700]
        failed += why is not None
        print(f"{'OK   ' if why is None else 'FAIL '} {name:28s} {time.time() - t:.2f}s {why or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
