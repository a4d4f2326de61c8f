"""Side-by-side check of a registered query against its DuckDB oracle.

Mirrors the driver's gate: columns sorted by name, row count, schema
names, and an order-insensitive comparison of canonicalised values.
"""

from __future__ import annotations

import datetime as dt
import math
import os

from quantspark.sources.tables import TABLES


def duckdb_views(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(float(v))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _canon(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _canon(v.tolist())
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_canon(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(pdf) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    rows = [tuple(_canon(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows)


def compare(spark, name: str, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols, s_rows = rows_of(sdf.toPandas())
    con = duckdb_views(sf_dir)
    d_cols, d_rows = rows_of(con.execute(sql).df())
    res = {"query": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": s_cols == d_cols, "values_match": s_rows == d_rows}
    if not res["columns_match"]:
        res["spark_cols"] = s_cols
        res["oracle_cols"] = d_cols
    elif not res["values_match"]:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:2]
        res["first_diff"] = [
            {c: (x, y) for c, x, y in zip(s_cols, a, b) if x != y} for a, b in diff]
    return res
