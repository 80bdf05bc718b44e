"""Compares a query's rows with its SQL's, run by DuckDB on the same tables."""

import os

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def plain(frame):
    frame, out = frame[sorted(frame.columns)], []
    for row in frame.itertuples(index=False):
        cells = []
        for x in row:
            x = x.tolist() if hasattr(x, "tolist") else x
            if isinstance(x, float):
                x = None if x != x else round(x, 6)
                x = int(x) if x is not None and x == int(x) else x
            cells.append(repr(None if x is pd.NaT or x is pd.NA else x))
        out.append(tuple(cells))
    return sorted(out)


def same(spark_frame, sql_frame):
    assert sorted(spark_frame.columns) == sorted(sql_frame.columns)
    assert plain(spark_frame) == plain(sql_frame)
