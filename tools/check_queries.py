"""Run every query beside its SQL twin and compare rows; argument: a scale folder, query names."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import workload  # noqa: E402
from pagemark.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    text = df.apply(
        lambda c: c.map(lambda v: "" if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v))
    )
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    kinds = {
        c: (str(got[c].dtype), str(want[c].dtype))
        for c in got.columns
        if got[c].dtype != want[c].dtype
    }
    a, b = canonical(got), canonical(want)
    if a.equals(b):
        return f"ok (types {kinds})" if kinds else "ok"
    bad = (a != b).any(axis=1)
    return f"{int(bad.sum())} rows differ, first:\n{a[bad].head(3)}\n{b[bad].head(3)}\ntypes {kinds}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8, "check")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle, failed = workload.oracle_sql(), []
    for name, query in workload.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            took = time.time() - start
            verdict = compare(got, con.sql(oracle[name]).df()) if name in oracle else "no twin"
        except Exception as e:  # noqa: BLE001
            took, verdict = time.time() - start, f"{type(e).__name__}: {str(e)[:600]}"
        if not verdict.startswith(("ok", "no twin")):
            failed.append(name)
        print(f"{name:28} {took:6.2f}s {len(got) if 'got' in locals() else 0:7} {verdict}", flush=True)
    print(f"failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
