"""Runs a query and its SQL on the same tables and compares all rows."""

import os

import duckdb


def cell(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def rows(df, columns):
    return sorted(tuple(cell(r[c]) for c in columns) for r in df.collect())


def same(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        path = f"{sf_dir}/{name}/*.parquet" if os.path.isdir(f"{sf_dir}/{name}") else f"{sf_dir}/{name}"
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    want = con.sql(sql)
    assert sorted(want.columns) == columns
    place = [want.columns.index(c) for c in columns]
    got, expected = rows(df, columns), sorted(tuple(cell(r[i]) for i in place) for r in want.fetchall())
    assert len(got) == len(expected)
    assert got == expected
    return got
