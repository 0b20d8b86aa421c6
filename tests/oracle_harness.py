"""Run a registered Spark query and its DuckDB oracle side by side."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return round(float(v), 6) + 0.0
    except Exception:
        pass
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, fn, sql: str, sf_dir: str, con=None):
    sdf = fn(spark, sf_dir).toPandas()
    con = con or duck(sf_dir)
    ddf = con.sql(sql).df()
    res = {"spark_rows": len(sdf), "oracle_rows": len(ddf),
           "spark_cols": sorted(sdf.columns), "oracle_cols": sorted(ddf.columns)}
    res["cols_ok"] = res["spark_cols"] == res["oracle_cols"]
    if res["cols_ok"]:
        a, b = rows_of(sdf), rows_of(ddf)
        res["values_ok"] = a == b
        if not res["values_ok"]:
            sa, sb = set(a), set(b)
            res["only_spark"] = sorted(sa - sb, key=str)[:5]
            res["only_oracle"] = sorted(sb - sa, key=str)[:5]
    else:
        res["values_ok"] = False
    return res
