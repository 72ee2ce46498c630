"""Runs a query and its SQL over the same tables and compares the rows."""

import glob
import os

import duckdb


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=repr)


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        path = f"{f}/*.parquet" if os.path.isdir(f) else f
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{path}'")
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    cols = sorted(names)
    return cols, sorted((tuple(_plain(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)


def _plain(v):
    return round(v, 9) if isinstance(v, float) else str(v) if hasattr(v, "isoformat") else v
