"""Queries over broken loads against their DuckDB twins, at sf0.001; the choice of a batch's mode."""

import pytest

import __spark_entry__ as se
from lakeops.operators.reconcile import CountSpec, cheaper_mode
from lakeops.plans import catalogue as cat
from lakeops.plans import recovery
from tools.check_oracle import compare

from conftest import SF_SMALL


def test_registered_with_their_twins():
    assert set(recovery.QUERIES) == set(recovery.ORACLE) and set(recovery.QUERIES) <= set(se.queries())
    assert not set(recovery.QUERIES) & set(cat.QUERIES)


@pytest.mark.parametrize("name", sorted(recovery.QUERIES))
def test_query_matches_oracle(spark, name):
    assert compare(spark, SF_SMALL, [name]) == 0


def test_shared_relations_are_counted_jointly():
    alone = [CountSpec(i, side, f"{side}{i}", None) for i in range(4) for side in ("source", "lake")]
    shared = [CountSpec(i, side, side, None) for i in range(4) for side in ("source", "lake")]
    assert cheaper_mode(alone) == "per_table" and cheaper_mode(shared) == "joint"


def test_auto_mode_gives_the_rows_of_the_others(spark):
    found = {}
    for mode in ("auto", "joint", "per_table"):
        run = cat.batch_result(spark, SF_SMALL, mode=mode)
        found[mode] = sorted((r.ID, r.STATUS, r.SOURCE_COUNT, r.DATALAKE_COUNT) for r in run.audit.collect())
    assert found["auto"] == found["joint"] == found["per_table"]
