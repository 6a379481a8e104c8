"""Run registered queries next to their SQL and compare values. Usable as a script."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normalised(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]")
        elif pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype("float64")
        else:
            df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(left: pd.DataFrame, right: pd.DataFrame, atol: float = 0.0) -> str | None:
    """None if both frames hold the same rows, else what differs."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(set(left.columns) ^ set(right.columns))}"
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}"
    a, b = normalised(left), normalised(right)
    for c in a.columns:
        if a[c].dtype == "float64" and b[c].dtype == "float64":
            same = np.isclose(a[c], b[c], rtol=0, atol=atol, equal_nan=True) if atol else (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        else:
            same = a[c] == b[c]
        if not np.all(same):
            i = int(np.argmin(np.asarray(same)))
            return f"column {c}: {int((~np.asarray(same)).sum())} rows, first {a[c][i]!r} vs {b[c][i]!r}"
    return None


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tideframe.session import build_session

    spark, con, sql, bad = build_session(), connect(folder), oracle_sql(), 0
    for name, build in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = build(spark, folder).toPandas()
            spent = time.time() - start
            verdict = "rows only" if name not in sql else None
            if name in sql:
                start = time.time()
                verdict = difference(got, con.execute(sql[name]).df())
        except Exception as error:  # noqa: BLE001
            got, spent, verdict = pd.DataFrame(), time.time() - start, f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed = verdict is not None and verdict != "rows only"
        bad += failed
        print(f"{'FAIL' if failed else 'ok  '} {name:28s} rows={len(got):7d} {spent:6.2f}s sql={time.time() - start:5.2f}s {verdict or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
