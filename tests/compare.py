"""Side-by-side run of the registered queries and their SQL."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.sql(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql) -> str | None:
    """None when both give the same columns and rows, else a short report."""
    got = spark_df.collect()
    want = con.sql(sql)
    if sorted(spark_df.columns) != sorted(want.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(want.columns)}"
    a = _rows([tuple(r) for r in got], spark_df.columns)
    b = _rows(want.fetchall(), want.columns)
    if a == b:
        return None if a else "no rows"
    return f"{sum(a.values())} vs {sum(b.values())} rows; only spark {list((a - b).items())[:3]}; only sql {list((b - a).items())[:3]}"
