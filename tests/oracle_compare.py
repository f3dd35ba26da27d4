"""Side-by-side check of a Spark result against DuckDB SQL on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

from hydroframe.sources.tables import TEST_TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v, places=6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, places)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item(), places)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, places) for x in v)
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]


def _key(row):
    return tuple((0, "") if v is None else (1, str(v)) for v in row)


def compare(spark_df, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    s_cols, s_rows = rows_of_spark(spark_df)
    d_cols, d_rows = rows_of_duck(con, sql)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    s_sorted, d_sorted = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            return False, f"first differing row: spark={a} duck={b}"
    return True, f"{len(s_rows)} rows match"
