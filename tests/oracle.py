"""Compares a registered query with its SQL, run by DuckDB on the same tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"


def value(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, int):
        return float(x) if abs(x) < 2**53 else x
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.9g}")
    if hasattr(x, "is_finite"):
        return float(f"{float(x):.9g}")
    return str(x)


def rows_of_sql(sql: str, sf: str):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        source = f"{p}/*.parquet" if p.is_dir() else p
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{source}')")
    out = con.sql(sql)
    names = list(out.columns)
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(value(r[i]) for i in order) for r in out.fetchall())


def rows_of_df(df):
    names = sorted(df.columns)
    return names, Counter(tuple(value(x) for x in r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def differ(df, sql: str, sf: str) -> str:
    """Empty if equal, else what differs."""
    (a, x), (b, y) = rows_of_df(df), rows_of_sql(sql, sf)
    if a != b:
        return f"columns {a} and {b}"
    if x != y:
        return f"{sum(x.values())} and {sum(y.values())} rows; only Spark: {list((x - y).items())[:3]}; only SQL: {list((y - x).items())[:3]}"
    return ""
