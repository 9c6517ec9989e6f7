"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as se
from feedlake.plans import catalog
from oracle_check import duck, rows_of

NAMES = sorted(catalog.oracle_sql())


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(se.queries()) and set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, name):
    df = catalog.queries()[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck(sf).execute(catalog.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = rows_of(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "competition_id"
