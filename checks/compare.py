"""Run the registered queries and their SQL side by side.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import numpy as np
import pandas as pd

from checks.oracle import ORACLE
from checks.queries import QUERIES
from skuloom.session import local_session

VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in VIEWS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as comparable text, rows in order."""
    out = {}
    for c in sorted(df.columns):
        col = df[c]
        if col.dtype.kind == "f":
            out[c] = col.map(lambda v: None if pd.isna(v) else repr(float(v) + 0.0))
        elif col.dtype.kind == "M":
            out[c] = col.map(lambda v: None if pd.isna(v) else pd.Timestamp(v).isoformat())
        else:
            out[c] = col.map(lambda v: None if v is None or v is pd.NaT or v is pd.NA or v != v else str(v))
    text = pd.DataFrame(out).fillna("\0")
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def kinds(df: pd.DataFrame) -> dict[str, str]:
    return {c: df[c].dtype.name for c in sorted(df.columns)}


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs, None if nothing does."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    a, b = normal(got), normal(want)
    if a.equals(b):
        return None
    wrong = [c for c in a.columns if not np.array_equal(a[c].to_numpy(), b[c].to_numpy())]
    at = np.flatnonzero((a != b).any(axis=1).to_numpy())[0]
    return f"values in {wrong[:6]}: {a.loc[at, wrong[:6]].tolist()} expected {b.loc[at, wrong[:6]].tolist()}"


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in ORACLE:
                print(f"{name}: {len(got)} rows, no SQL, {took:.2f} s")
                continue
            want = con.execute(ORACLE[name]).df()
            wrong = difference(got, want)
            note = "" if kinds(got) == kinds(want) else " types: " + str(
                {c: (k, kinds(want).get(c)) for c, k in kinds(got).items() if kinds(want).get(c) != k}
            )
        except Exception as e:  # noqa: BLE001
            wrong, note, took = f"{type(e).__name__}: {str(e)[:600]}", "", time.time() - start
            got = []
        bad += wrong is not None
        print(f"{name}: {'ok' if wrong is None else 'DIFFERS ' + wrong} ({len(got)} rows, {took:.2f} s){note}", flush=True)
    print(f"{bad} of {len(names)} differ")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
