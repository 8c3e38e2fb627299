"""Comparing a DataFrame with DuckDB's result of a SQL text."""

import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir, sql):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    got = con.sql(sql)
    return got.columns, got.fetchall()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.9g}"
    return v


def assert_equal(df, sf_dir, sql):
    columns, rows = duck(sf_dir, sql)
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    a = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=str)
    b = sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in rows), key=str)
    assert a == b
