"""Every query with SQL gives the rows of its SQL; the others run and have a stable schema."""

import pytest

from foliospark.plans import catalogue
from tests.compare import same


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_against_sql(spark, sf_dir, name):
    assert same(catalogue.QUERIES[name](spark, sf_dir), catalogue.SQL[name], sf_dir) > 0


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_runs(spark, sf_dir, name):
    assert catalogue.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "uuid" in entry.entry(spark).columns
