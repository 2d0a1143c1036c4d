"""Run a query's SQL in DuckDB on the same tables and compare rows whatever their order."""

import decimal
import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        return plain(v.tolist())
    return [plain(x) for x in v] if isinstance(v, list | tuple) else v


def rows(frame, columns):
    return sorted((tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False)), key=repr)


def database(folder, tables=None):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    for name, frame in (tables or {}).items():
        db.register(f"_{name}", frame)
        db.execute(f"create or replace view {name} as select * from _{name}")
    return db


def check(found, sql, folder, tables=None):
    """found: pandas rows of the Spark query."""
    expected = database(folder, tables).execute(sql).df()
    columns = sorted(expected.columns)
    assert columns == sorted(found.columns)
    assert rows(found, columns) == rows(expected, columns)
