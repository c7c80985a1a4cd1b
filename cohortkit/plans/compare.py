"""Side-by-side check of a registered query against its DuckDB oracle:
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

from ..sources.fixtures import BASE_TABLES

ORACLE_TABLES = BASE_TABLES + ("documents", "embeddings", "pages", "benchmark", "labels",
                               "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    import os
    for t in ORACLE_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits: int):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{round(v, digits):.{digits}f}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def frame_hash(df: pd.DataFrame, digits: int = 6) -> str:
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c], digits) for c in cols) for r in df[cols].to_dict("records"))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def _py(df: pd.DataFrame) -> pd.DataFrame:
    out = df.astype(object).where(df.notna(), None)
    for c in out.columns:
        out[c] = [(x.item() if hasattr(x, "item") else x) for x in out[c]]
        out[c] = [(x.to_pydatetime() if hasattr(x, "to_pydatetime") else x) for x in out[c]]
        out[c] = [(float(x) if isinstance(x, int) and not isinstance(x, bool) else x) for x in out[c]]
    return out


def compare(spark_df, sql: str, con, digits: int = 6) -> dict:
    s = _py(spark_df.toPandas())
    o = _py(con.sql(sql).df())
    res = {"rows_spark": len(s), "rows_oracle": len(o),
           "cols_match": sorted(s.columns) == sorted(o.columns)}
    res["rows_match"] = res["rows_spark"] == res["rows_oracle"]
    res["hash_match"] = res["cols_match"] and frame_hash(s, digits) == frame_hash(o, digits)
    if not res["cols_match"]:
        res["cols"] = (sorted(s.columns), sorted(o.columns))
    return res
