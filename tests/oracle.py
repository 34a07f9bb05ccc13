"""Compares a query with its SQL over the same tables."""

import glob
import os

import duckdb
import pandas as pd


def connection(d):
    con = duckdb.connect()
    for p in glob.glob(f"{d}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def rows(columns, values):
    def cell(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
            return "NULL"
        return f"{float(x):.6f}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(v[i]) for i in order) for v in values)


def check(con, sql, df):
    r = con.sql(sql)
    assert rows(df.columns, [tuple(x) for x in df.collect()]) == rows(r.columns, r.fetchall())
