"""Loads: marks, merge idempotence, partition-scoped merge, full-load overwrite."""

import datetime as dt

from pyspark.sql import functions as F

from lakeops.operators.ingest import (LakeLocation, advance_marks, latest_per_key, load_full,
                                      load_incremental, load_merge, run_ingestion)
from lakeops.plans import catalogue as cat
from lakeops.plans import fixtures as fx
from lakeops.session import scratch_path
from lakeops.sources.lake import SparkSources

from conftest import SF_MID


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_reports_rows_and_new_mark(spark):
    lake = LakeLocation(spark, root=scratch_path(spark, "t-lake"))
    li = fx.read_table(spark, SF_MID, "lineitem")
    mark = dt.datetime(2001, 6, 1)
    load_full(li.where(F.col("l_shipdate") <= F.lit("2001-06-01").cast("timestamp_ntz")), lake, "li")
    res = load_incremental(li, lake, "li", "l_shipdate", mark)
    assert res.rows == 3671
    assert res.new_mark == li.agg(F.max("l_shipdate")).first()[0]
    again = load_incremental(li, lake, "li", "l_shipdate", res.new_mark)
    assert again.rows == 0 and again.new_mark == res.new_mark
    assert lake.read("li").count() == 60000


def test_merge_twice_equals_once(spark):
    fx.register(spark, SF_MID)
    upd = spark.sql(cat.ORDERS_UPD_SQL)
    lake = LakeLocation(spark, root=scratch_path(spark, "t-lake"))
    load_full(spark.table("orders_lake"), lake, "o")
    mark = dt.datetime(2001, 6, 1)
    load_merge(upd, lake, "o", ["o_orderkey"], "o_orderdate", mark)
    once = _rows(lake.read("o"))
    load_merge(upd, lake, "o", ["o_orderkey"], "o_orderdate", mark)
    assert _rows(lake.read("o")) == once
    load_merge(upd, lake, "o", ["o_orderkey"], "o_orderdate", mark, unique_keys=True)
    assert _rows(lake.read("o")) == once
    assert len(once) == 14705
    assert round(sum(r[3] for r in once), 2) == 3787369219.54


def test_partitioned_merge_equals_unpartitioned(spark):
    fx.register(spark, SF_MID)
    y = lambda df: df.withColumn("o_year", F.year("o_orderdate"))
    flat = LakeLocation(spark, root=scratch_path(spark, "t-flat"))
    part = LakeLocation(spark, root=scratch_path(spark, "t-part"))
    base, upd = y(spark.table("orders_lake")), y(spark.sql(cat.ORDERS_UPD_SQL))
    load_full(base, flat, "o")
    load_full(base, part, "o", ["o_year"])
    mark = dt.datetime(2001, 6, 1)
    load_merge(upd, flat, "o", ["o_orderkey"], "o_orderdate", mark)
    load_merge(upd, part, "o", ["o_orderkey"], "o_orderdate", mark, partition_by=["o_year"])
    cols = flat.read("o").columns
    assert _rows(part.read("o").select(*cols)) == _rows(flat.read("o"))


def test_latest_per_key_keeps_the_newest_even_for_a_hot_key(spark):
    rows = [(1, i, f"v{i}") for i in range(3000)] + [(k, 0, "x") for k in range(2, 1000)]
    df = spark.createDataFrame(rows, "k long, ver long, v string")
    got = {r.k: (r.ver, r.v) for r in latest_per_key(df, ["k"], "ver").collect()}
    assert got[1] == (2999, "v2999") and len(got) == 999


def test_full_load_replaces_all_partitions(spark):
    lake = LakeLocation(spark, root=scratch_path(spark, "t-lake"))
    o = fx.read_table(spark, SF_MID, "orders").withColumn("y", F.year("o_orderdate"))
    load_full(o, lake, "o", ["y"])
    load_full(o.where(F.col("y") == 1996), lake, "o", ["y"])
    assert {r.y for r in lake.read("o").select("y").distinct().collect()} == {1996}


def test_run_and_advance_marks(spark):
    fx.register(spark, SF_MID)
    lake = LakeLocation(spark, root=scratch_path(spark, "t-lake"))
    entries = cat.ingestion_control(spark, SF_MID)
    li = fx.read_table(spark, SF_MID, "lineitem")
    load_full(fx.lineitem_lake(li).where(F.col("l_shipdate") <= F.lit("2001-06-01").cast("timestamp_ntz")),
              lake, "lineitem")
    run = run_ingestion(spark, entries, SparkSources(spark), lake, job_name="J", batch="B")
    assert run[0] == 4 and run[1] == 1
    ctl = spark.createDataFrame(
        [(e.id, e.startdatetime, e.offset_value) for e in entries],
        "id long, startdatetime timestamp_ntz, offset_value long")
    moved = {r.id: r for r in advance_marks(ctl, run).collect()}
    assert moved[2].startdatetime == li.agg(F.max("l_shipdate")).first()[0]
    assert moved[3].offset_value == fx.read_table(spark, SF_MID, "events").count() - 1


def test_parallel_run_equals_sequential(spark):
    fx.register(spark, SF_MID)
    out = {}
    for par in (1, 4):
        lake = LakeLocation(spark, root=scratch_path(spark, "t-lake"))
        run = run_ingestion(spark, cat.ingestion_control(spark, SF_MID), SparkSources(spark), lake,
                            job_name="J", batch="B", max_parallel=par)
        out[par] = [(r.ID, r.STATUS, r.ROWS_LOADED) for r in run.audit.collect()]
    assert out[1] == out[4] and [i for i, *_ in out[1]] == [1, 2, 3, 4, 5]


def test_partitioned_merge_moving_rows_empties_their_old_partition(spark):
    lake = LakeLocation(spark, root=scratch_path(spark, "t-move"))
    o = fx.read_table(spark, SF_MID, "orders").withColumn("o_year", F.year("o_orderdate"))
    load_full(o, lake, "o", ["o_year"])
    # every 2001 order is re-dated into 2002: year 2001 must disappear
    moved = o.where(F.col("o_year") == 2001).withColumn(
        "o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 365 DAYS")).withColumn("o_year", F.lit(2002))
    load_merge(moved, lake, "o", ["o_orderkey"], partition_by=["o_year"])
    back = lake.read("o")
    years = {r.o_year: r.n for r in back.groupBy("o_year").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert 2001 not in years and years[2002] == o.where(F.col("o_year") == 2001).count()
    assert back.count() == o.count()
    assert back.select("o_orderkey").distinct().count() == o.count()


def test_first_incremental_load_without_a_mark_loads_everything(spark):
    lake = LakeLocation(spark, root=scratch_path(spark, "t-first"))
    ev = fx.read_table(spark, SF_MID, "events")
    res = load_incremental(ev, lake, "ev", "event_id", None)
    assert res.rows == ev.count() and res.new_mark == ev.count() - 1
    again = load_incremental(ev, lake, "ev", "event_id", res.new_mark)
    assert again.rows == 0 and lake.read("ev").count() == ev.count()
