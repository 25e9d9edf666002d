"""Every catalog query equals its DuckDB oracle (rows, columns, exact values)."""

import pytest

import __spark_entry__ as E
from fleetscope.plans.catalog import QUERIES
from fleetscope.plans.oracle import oracle_sql
from tests.conftest import SF_ORACLE
from tools.check_oracle import rows_of

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_ORACLE)
    s_cols, s_rows = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = duck.sql(oracle_sql()[name])
    o_cols, o_rows = rows_of(list(res.columns), res.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["client", "host", "x", "y"]
    assert df.count() > 0
