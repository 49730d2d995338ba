"""Every registered query against its DuckDB twin, at sf0.001."""

import pytest

import __spark_entry__ as se
from lakeops.plans import catalogue
from tools.check_oracle import compare

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() == 5 and "COUNT_DIFF" in df.columns


def test_every_query_has_an_oracle():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE)
    assert set(catalogue.QUERIES) <= set(se.queries()) and set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_oracle(spark, name):
    assert compare(spark, SF_SMALL, [name]) == 0
