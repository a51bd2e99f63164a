import os

import pytest
from oracle_tables import run_sql

from tallyloom.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"


def plain(v):
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    names, rows = run_sql(SF, SQL[name])
    df = QUERIES[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    order = lambda r: tuple((x is not None, str(x)) for x in r)
    own = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=order)
    other = sorted((tuple(map(plain, r)) for r in rows), key=order)
    assert len(own) == len(other) and own
    assert own == other


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_others_run(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
