"""Runs a query and its SQL on the same tables and compares all values."""

from __future__ import annotations

import os

import pytest

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def run_sql(sf_dir: str, sql: str):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    got = con.execute(sql)
    return [x[0] for x in got.description], got.fetchall()


def assert_same(df, sf_dir: str, sql: str) -> None:
    names, rows = run_sql(sf_dir, sql)
    assert sorted(names) == sorted(df.columns)
    own = [tuple(r[n] for n in names) for r in df.collect()]
    order = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(own, key=order) == sorted(rows, key=order)
