"""Compare a Spark query with its DuckDB oracle: column names, row count
and the multiset of rows (doubles compared to 9 decimals)."""

from __future__ import annotations

import math

from vartab.plans.fixtures import BASE_TABLES


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{round(v, 9):.9f}")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, f"{float(v):.9f}")
    return (3, str(v))


def _rows(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def compare_query(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [r.asDict() for r in df.collect()]
    if sql is None:
        return True, f"rows={len(s_rows)} (no oracle)"
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = [dict(zip(d_cols, r)) for r in res.fetchall()]
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark-only={sorted(set(s_cols) - set(d_cols))} " \
                      f"duckdb-only={sorted(set(d_cols) - set(s_cols))}"
    if len(set(s_cols)) != len(s_cols):
        return False, f"duplicate columns {s_cols}"
    cols = sorted(s_cols)
    if len(s_rows) != len(d_rows):
        return False, f"rows spark={len(s_rows)} duckdb={len(d_rows)}"
    a, b = _rows(s_rows, cols), _rows(d_rows, cols)
    if a != b:
        diff = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
        return False, f"values differ at sorted row {diff}: spark={a[diff]} duckdb={b[diff]}"
    return True, f"rows={len(s_rows)}"
