"""Every query of the catalog equals its DuckDB oracle (sf0.001 here; the round
driver repeats this at sf0.01), and entry() runs."""

import pytest

import __spark_entry__ as E
from lakestrata.catalog import QUERIES
from conftest import SF001
from oracle_compare import compare


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"market", "customers", "lifetime_net_revenue", "revenue_last_30_days"}
    assert df.count() == 5


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    assert compare(spark, SF001, [name], verbose=False)[name] is True
