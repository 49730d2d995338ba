"""Batch reconciliation: goldens, failure isolation, modes, scan sharing."""

import dataclasses
import datetime as dt

import pytest

from lakeops.operators.control import ControlEntry
from lakeops.operators.reconcile import (counts_frame, plan_reconcile, reconcile_frame,
                                         run_reconcile)
from lakeops.plans import catalogue as cat
from lakeops.plans import fixtures as fx
from lakeops.sources.lake import LakeTables, SparkSources

from conftest import SF_MID


def _by_id(df):
    return {r.ID: r for r in df.collect()}


def test_batch_goldens_sf001(spark):
    res = cat.batch_result(spark, SF_MID)
    rows = _by_id(res.audit)
    assert set(rows) == {1, 2, 3, 4, 5}
    got = {i: (r.SOURCE_COUNT, r.DATALAKE_COUNT, r.COUNT_DIFF, r.STATUS) for i, r in rows.items()}
    assert got[1] == (15000, 14700, 300, "SUCCESS")
    assert got[2] == (705, 25819, -25114, "SUCCESS")
    assert got[3] == (7501, 7313, 188, "SUCCESS")
    assert got[4] == (7129, 6951, 178, "SUCCESS")
    assert got[5] == (None, None, None, "FAILED")
    assert 0 < len(rows[5].ERROR_MESSAGE) <= 1000
    assert sorted(e.id for e in res.skipped) == [6, 7]
    assert res.mode == "joint"
    assert rows[1].SRC_QUERY_EXEC_TIME and rows[5].SRC_QUERY_EXEC_TIME is None


def test_per_table_mode_fills_elapsed_and_agrees(spark):
    joint = _by_id(cat.batch_result(spark, SF_MID).audit)
    per = cat.batch_result(spark, SF_MID, mode="per_table")
    assert per.mode == "per_table"
    rows = _by_id(per.audit)
    for i in (1, 2, 3, 4):
        assert rows[i].SOURCE_COUNT == joint[i].SOURCE_COUNT
        assert rows[i].DATALAKE_COUNT == joint[i].DATALAKE_COUNT
        assert rows[i].SRC_QUERY_EXEC_TIME is not None
        assert rows[i].TARGET_QUERY_EXEC_TIME.count(":") == 2


def test_runtime_failure_is_isolated(spark):
    fx.register(spark, SF_MID)
    # fails only while rows are read: every order key is >= 0
    spark.sql("CREATE OR REPLACE TEMP VIEW broken AS SELECT o_orderkey, "
              "CAST(assert_true(o_orderkey < 0, 'boom') AS BIGINT) AS x FROM orders")
    entries = [
        ControlEntry(1, 1, "SELECT * FROM orders", "oracle", "orders_lake", "Full Load"),
        ControlEntry(2, 1, "SELECT o_orderkey, x FROM broken", "mssql", "orders_lake", "merge",
                     dt.datetime(2024, 1, 1), "x", 5),
    ]
    res = run_reconcile(spark, entries, SparkSources(spark), LakeTables(spark),
                        job_name="J", batch="B")
    rows = _by_id(res.audit)
    assert res.mode == "per_table"
    assert rows[1].STATUS == "SUCCESS" and rows[1].COUNT_DIFF == 300
    assert rows[2].STATUS == "FAILED" and "boom" in rows[2].ERROR_MESSAGE


def test_missing_column_fails_only_its_table(spark):
    fx.register(spark, SF_MID)
    entries = [
        ControlEntry(1, 1, "SELECT * FROM orders", "oracle", "orders_lake", "Full Load"),
        ControlEntry(2, 1, "SELECT * FROM lineitem", "oracle", "lineitem_lake", "incremental",
                     dt.datetime(1998, 12, 1), "no_such_column"),
        ControlEntry(3, 1, "SELECT * FROM lineitem", "oracle", "lineitem_lake", "incremental",
                     None, "l_shipdate"),
    ]
    rows = _by_id(run_reconcile(spark, entries, SparkSources(spark), LakeTables(spark),
                                job_name="J", batch="B").audit)
    assert rows[1].STATUS == "SUCCESS"
    assert rows[2].STATUS == "FAILED" and rows[3].STATUS == "FAILED"


def test_specs_on_one_relation_share_one_scan(spark):
    fx.register(spark, SF_MID)
    mark = dt.datetime(1998, 12, 1)
    entries = [ControlEntry(i, 1, "SELECT * FROM lineitem", "oracle", "lineitem_lake",
                            "incremental", mark, "l_shipdate") for i in (1, 2)]
    plan = plan_reconcile(spark, entries, SparkSources(spark), LakeTables(spark))
    frame = counts_frame(plan.specs)
    text = frame._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation ") == 2        # lineitem once for 2 sources, once for 2 lakes
    got = {(r.SLOT, r.SIDE): r.CNT for r in frame.collect()}
    assert got[(0, "source")] == got[(1, "source")] == 705
    assert got[(0, "lake")] == got[(1, "lake")] == 25819


def test_window_counts_are_pushed_to_the_scan(spark):
    fx.register(spark, SF_MID)
    e = ControlEntry(2, 1, "SELECT * FROM lineitem", "oracle", "lineitem_lake", "incremental",
                     dt.datetime(1998, 12, 1), "l_shipdate")
    plan = plan_reconcile(spark, [e], SparkSources(spark), LakeTables(spark))
    text = counts_frame(plan.specs)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThan(l_shipdate" in text


def test_full_load_ignores_a_missing_mark_and_null_offset_means_window(spark):
    fx.register(spark, SF_MID)
    entries = [
        ControlEntry(1, 1, "SELECT * FROM orders", "oracle", "orders_lake", "Full Load", None),
        ControlEntry(2, 1, "SELECT * FROM lineitem", "oracle", "lineitem_lake", "Merge",
                     dt.datetime(1998, 12, 1), "l_shipdate", None),
    ]
    rows = _by_id(run_reconcile(spark, entries, SparkSources(spark), LakeTables(spark),
                                job_name="J", batch="B").audit)
    assert (rows[1].STATUS, rows[1].COUNT_DIFF) == ("SUCCESS", 300)
    assert (rows[2].SOURCE_COUNT, rows[2].DATALAKE_COUNT) == (705, 25819)


def test_duplicate_control_ids_keep_their_own_counts(spark):
    fx.register(spark, SF_MID)
    entries = [
        ControlEntry(7, 1, "SELECT * FROM orders", "oracle", "orders_lake", "Full Load"),
        ControlEntry(7, 1, "SELECT * FROM lineitem", "oracle", "lineitem_lake", "incremental",
                     dt.datetime(1998, 12, 1), "l_shipdate"),
    ]
    for mode in ("joint", "per_table"):
        rows = run_reconcile(spark, entries, SparkSources(spark), LakeTables(spark),
                             job_name="J", batch="B", mode=mode).audit.collect()
        assert sorted((r.TABLE_NAME, r.COUNT_DIFF) for r in rows) == [
            ("lineitem_lake", 705 - 25819), ("orders_lake", 300)]
    plan = plan_reconcile(spark, entries, SparkSources(spark), LakeTables(spark))
    lazy = sorted((r.TABLE_NAME, r.COUNT_DIFF) for r in reconcile_frame(spark, plan, "J", "B").collect())
    assert lazy == [("lineitem_lake", 705 - 25819), ("orders_lake", 300)]


def test_more_control_rows_than_one_scan_takes(spark):
    from conftest import SF_SMALL
    fx.register(spark, SF_SMALL)
    marks = [dt.datetime(1992, 1, 1) + dt.timedelta(days=30 * i) for i in range(70)]
    entries = [ControlEntry(i, 1, "SELECT * FROM lineitem", "oracle", "lineitem_lake",
                            "incremental", m, "l_shipdate") for i, m in enumerate(marks)]
    plan = plan_reconcile(spark, entries, SparkSources(spark), LakeTables(spark))
    text = counts_frame(plan.specs)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation ") == 2       # 70 counts per side -> one scan per relation
    got = {r.ID: (r.SOURCE_COUNT, r.DATALAKE_COUNT) for r in
           run_reconcile(spark, entries, SparkSources(spark), LakeTables(spark),
                         job_name="J", batch="B").audit.collect()}
    li = spark.table("lineitem")
    lake = spark.table("lineitem_lake")
    for i in (0, 40, 69):
        lo, hi = marks[i] - dt.timedelta(days=30), marks[i]
        want_src = li.where((li.l_shipdate > lo) & (li.l_shipdate <= hi)).count()
        want_lake = lake.where(lake.l_shipdate > lo).count()
        assert got[i] == (want_src, want_lake)


@pytest.mark.parametrize("upper", [False, True])
def test_searched_counts_equal_one_predicate_a_mark(spark, monkeypatch, upper):
    """Text and rounded values, NULLs, marks that many rows hit exactly, offsets, columns in order."""
    from lakeops.operators import reconcile as rec
    d = dt.datetime
    rows = [(i, None if i % 7 == 0 else str(d(2024, 1, 1) + dt.timedelta(hours=i, microseconds=499 + i % 3)),
             "bad" if i % 5 == 0 else str(d(2024, 1, 2) + dt.timedelta(hours=i))) for i in range(900)]
    spark.createDataFrame(rows, "k long, a string, b string").createOrReplaceTempView("searched_src")
    spark.sql("SELECT k, try_cast(a AS timestamp_ntz) AS a, try_cast(b AS timestamp_ntz) AS b FROM searched_src "
              "WHERE k % 11 <> 0").createOrReplaceTempView("searched_lake")
    entries = [ControlEntry(i, 1, "SELECT * FROM searched_src", "mssql" if i % 2 else "oracle", "searched_lake", "merge",
                            d(2024, 1, 1) + dt.timedelta(hours=13 * i, microseconds=(0, 500, 499, 1500)[i % 4]),
                            ("a, b", "b")[i % 3 == 0]) for i in range(60)]
    entries = [dataclasses.replace(e, source="mssql") for e in entries]
    entries += [ControlEntry(100 + i, 1, "SELECT * FROM searched_src", "x", "searched_lake", "merge", None, "k", 40 * i - 5)
                for i in range(30)]
    found = {}
    for least in (10 ** 9, 1):
        monkeypatch.setattr(rec, "SEARCHED_MARKS", least)
        run = rec.run_reconcile(spark, entries, SparkSources(spark), LakeTables(spark), job_name="J", batch="B", days=3,
                                lake_upper_bound=upper)
        found[least] = sorted((r.ID, r.STATUS, r.SOURCE_COUNT, r.DATALAKE_COUNT) for r in run.audit.collect())
    assert found[1] == found[10 ** 9] and all(r[1] == "SUCCESS" for r in found[1]) and len(found[1]) == 90


def test_batches_keep_tables_that_share_a_relation_together():
    from lakeops.operators.reconcile import BATCH_TABLES, CountSpec, _batches
    specs = [CountSpec(i, side, key, None) for i in range(200)
             for side, key in (("source", f"s{i % 40}"), ("lake", f"l{i}"))]
    batches = _batches(specs)
    home = {}
    for n, batch in enumerate(batches):
        for s in batch:
            assert home.setdefault(s.relation_key, n) == n
    assert sum(len(b) for b in batches) == 400
    assert all(len({s.slot for s in b}) <= BATCH_TABLES for b in batches)
    alone = _batches([CountSpec(i, "source", "one", None) for i in range(100)])
    assert len(alone) == 1
