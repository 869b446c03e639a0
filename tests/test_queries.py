"""Every registered query with SQL agrees with it; the others return rows."""

import os

import oracle
import pytest

import __spark_entry__ as entry_points

SF = f"{oracle.TESTDATA}/sf0.001"
MODELS = {"gbt_predictions", "gbt_metrics", "gbt_importance", "gbt_attribution", "gbt_attribution_wide", "forecast_explanations", "forecast_standings_long"}
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, SF), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - MODELS))
def test_query_returns_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
