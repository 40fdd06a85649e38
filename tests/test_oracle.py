"""Every registered query against its DuckDB oracle on the smallest tables,
and the marts on sf0.01 (where the correlation mart is non-empty)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_MID, SF_SMALL
from tests.harness import compare, duck

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle_small(spark, duck_small, name):
    r = compare(spark, duck_small, SF_SMALL, name, QUERIES[name], SQL[name])
    assert r["ok"], r


@pytest.mark.parametrize("name", ["price_fact", "risk_mart", "correlation_mart", "asset_dim",
                                  "rolling_beta_global_denominator"])
def test_oracle_mid(spark, name):
    r = compare(spark, duck(SF_MID), SF_MID, name, QUERIES[name], SQL[name])
    assert r["ok"], r
    assert r["spark_rows"] > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["id", "symbol", "trade_date"]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0
