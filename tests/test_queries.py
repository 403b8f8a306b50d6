"""Every named query against its SQL text, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from oreflow.queries import all_queries as queries
from oreflow.queries import all_sql as oracle_sql
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, SF, queries()[name], oracle_sql().get(name))
    assert ok, note


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry(spark), entry(spark)
    assert first.schema == second.schema
    assert first.count() == 3549


def test_only_trained_models_have_no_sql():
    assert set(queries()) - set(oracle_sql()) == {
        "forecast_90d",
        "forest_metrics",
        "forest_by_country",
        "fraud_scores",
        "score_batch",
        "score_stream",
    }
