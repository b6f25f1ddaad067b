"""Spark results against DuckDB's, without regard to order."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(directory):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{directory}/{t}.parquet"
        if not os.path.exists(path):
            continue
        con.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def cell(x):
    if x is None or (not isinstance(x, (list, dict)) and not hasattr(x, "shape") and pd.isna(x)):
        return "null"
    if isinstance(x, (bool, str)):
        return str(x)
    if hasattr(x, "isoformat"):
        return x.isoformat().removesuffix("T00:00:00")
    if hasattr(x, "__float__"):
        return f"{float(x):.6f}"
    return str(x)


def canonical(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, row)) for row in frame.itertuples(index=False))
