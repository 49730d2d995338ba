"""Physical-plan properties the design relies on."""

import datetime as dt

import pytest

from lakeops.functions.predicates import pending
from lakeops.operators.ingest import LakeLocation, latest_per_key, load_full, merged_rows
from lakeops.plans import catalogue as cat
from lakeops.plans import fixtures as fx
from lakeops.session import scratch_path

from conftest import SF_SMALL

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas")


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(cat.QUERIES))
def test_no_nested_loops_cartesians_or_python(spark, name):
    plan = _executed(cat.QUERIES[name](spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in plan]


def test_partition_scoped_merge_prunes_the_target_scan(spark):
    fx.register(spark, SF_SMALL)
    lake = LakeLocation(spark, root=scratch_path(spark, "t-dpp"))
    load_full(cat._with_year(spark.table("orders_lake")), lake, "orders", ["o_year"])
    upd = latest_per_key(cat._with_year(spark.sql(cat.ORDERS_UPD_SQL))
                         .where(pending("o_orderdate", dt.datetime(2001, 6, 1))), ["o_orderkey"])
    plan = _executed(merged_rows(lake.read("orders"), upd, ["o_orderkey"], ["o_year"]))
    assert "dynamicpruning" in plan
