"""Runs a query's SQL on the same tables."""

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
