"""Holds a query's rows against its SQL in DuckDB, over the smallest test tables."""

import math
from pathlib import Path

import duckdb

DIR = "/root/testdata/sf0.001"


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(float(v)) if isinstance(v, float) else str(v).removesuffix(" 00:00:00")


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_value(r[i]) for i in order) for r in data)


def sql_rows(sql):
    con = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    return sorted(columns), rows(columns, found.fetchall())


def check(spark, query, sql):
    df = query(spark, DIR)
    columns, want = sql_rows(sql)
    assert sorted(df.columns) == columns
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == want
