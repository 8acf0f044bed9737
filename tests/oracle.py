"""Comparison of a query's rows with those of its SQL in DuckDB."""

import glob
import math
import os

import duckdb
import pandas as pd


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        files = path if os.path.isfile(path) else f"{path}/*.parquet"
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{files}'")
    return con


def canon(value):
    if value is None or value is pd.NaT:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, int):
        return f"{float(value):.6f}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(canon, value)) + "]"
    return str(value)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), sorted(tuple(canon(v[k]) for k in order) for v in values)


def compare(df, con, sql):
    cursor = con.execute(sql)
    expected = rows([d[0] for d in cursor.description], cursor.fetchall())
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == expected
