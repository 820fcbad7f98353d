"""Every query with an oracle agrees with DuckDB on the smallest data."""

import pytest
from compare import compare, connect

from pulse.plans.all_queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["platform", "month", "monthly_engagement", "prev_month_engagement", "mom_growth_pct"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
