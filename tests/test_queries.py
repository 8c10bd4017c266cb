"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect

from tidemark.plans import QUERIES, SQL

# fits of 50 trees; tests/test_training.py has fits with known answers
SLOW = {"m04_forest", "m05_boosted", "m06_holdout", "m07_ensemble", "m08_importance"}


@pytest.fixture(scope="module")
def duck(sf_small):
    return connect(sf_small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, sf_small, name):
    problem, _ = compare(QUERIES[name](spark, sf_small), duck, SQL[name])
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_rows_only(spark, sf_small, name):
    assert QUERIES[name](spark, sf_small).count() > 0


def test_flagship_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["reason", "n", "net"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
