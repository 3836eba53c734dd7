"""Every SQL-expressible registered query equals its DuckDB oracle (the driver's gate)."""

import pytest

from conftest import SF001, SF01
from harness import compare, duck

from rankloom.oracle_sql import SQL
from rankloom.queries import QUERIES

NAMES = sorted(n for n in QUERIES if n in SQL)


@pytest.fixture(scope="module")
def cons():
    return {SF01: duck(SF01), SF001: duck(SF001)}


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle_sf001(spark, cons, name):
    rows, problems = compare(spark, name, SF01, cons[SF01])
    assert not problems, problems


@pytest.mark.parametrize("name", ["model1_matrix", "model2_matrix", "model3_matrix",
                                  "model4_matrix", "latest_category_ties", "ranking_metrics"])
def test_matches_oracle_sf0001(spark, cons, name):
    rows, problems = compare(spark, name, SF001, cons[SF001])
    assert not problems, problems


def test_every_query_has_oracle_or_is_trained():
    missing = [n for n in QUERIES if n not in SQL]
    assert all(n.startswith("als_") or n == "split_random" for n in missing), missing
    assert {"als_scored_pairs_m1", "als_scored_pairs_m3", "als_factor_index", "als_listed_products",
            "als_listed_users"} <= set(SQL)


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 238
    assert set(e.oracle_sql()) <= set(e.queries())
