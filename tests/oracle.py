"""Run a catalogue query on Spark and its SQL twin on DuckDB; compare the results.

Comparison is order-insensitive: columns sorted by name, rows sorted, values
normalised (dates/timestamps to ISO text, floats compared with a relative
tolerance of 1e-9).
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):  # numpy scalars
        return _norm(v.item())
    return v


def _key(row):
    return tuple((0, "") if v is None else (1, repr(v) if isinstance(v, float) else str(v)) for v in row)


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return [columns[i].lower() for i in order], sorted(rows, key=_key)


def _same(a, b, exact: bool = False) -> bool:
    if exact:
        return a == b
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-12)
    return a == b


def compare(spark, query, sql: str, sf_dir: str, con=None, exact: bool = False) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    sc, sr = _rows(s_cols, s_rows)
    dc, dr = _rows(d_cols, d_rows)
    out = {"spark_rows": len(sr), "oracle_rows": len(dr), "columns_match": sc == dc}
    if not out["columns_match"]:
        out["spark_columns"], out["oracle_columns"] = sc, dc
    mismatch = None
    if len(sr) == len(dr) and sc == dc:
        # floats may differ in the last bits; sort keys use repr, so pair rows by non-float fields
        for a, b in zip(sr, dr):
            if not all(_same(x, y, exact) for x, y in zip(a, b)):
                mismatch = (a, b)
                break
    out["values_match"] = out["columns_match"] and len(sr) == len(dr) and mismatch is None
    if mismatch:
        out["first_mismatch"] = [str(mismatch[0]), str(mismatch[1])]
    return out
