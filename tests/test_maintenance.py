"""Running sums under skew, compaction, expiry, orphans, sweeps."""

import datetime as dt

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.functions.running import grouped_running_sum
from lakeops.operators import maintenance as mnt
from lakeops.session import scratch_path
from lakeops.plans import fixtures as fx

from conftest import SF_MID


def test_running_sum_matches_plain_window_with_a_hot_group(spark):
    # group 'hot' holds a third of the rows; order values have ties
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("g"),
        (F.col("id") % 5000).alias("o"), F.col("id").alias("tie"), ((F.col("id") * 7) % 13).alias("v"))
    got = grouped_running_sum(df, ["g"], "o", "v", "rs", tie_cols=["tie"], chunks=16)
    w = Window.partitionBy("g").orderBy("o", "tie").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("rs", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == 30000


def test_running_sum_without_groups(spark):
    df = spark.range(1000).select(F.col("id").alias("o"), F.lit(2).alias("v"))
    got = {r.o: r.rs for r in grouped_running_sum(df, [], "o", "v", "rs").collect()}
    assert got[0] == 0 and got[999] == 1998


def test_compaction_keeps_rows_and_reduces_files(spark):
    li = fx.read_table(spark, SF_MID, "lineitem")
    path = scratch_path(spark, "t-small")
    li.repartition(24).write.partitionBy("l_returnflag").parquet(path)
    inv = mnt.file_inventory(spark, path)
    before = inv.count()
    target = int(inv.agg(F.sum("size")).first()[0] // 6)
    plan = mnt.compaction_plan(inv, partition_cols=["l_returnflag"], order_col="modified",
                               tie_cols=["path"], target_bytes=target)
    dry = mnt.rewrite_bins(spark, path, plan, ["l_returnflag"], dry_run=True)
    assert dry.dry_run and mnt.file_inventory(spark, path).count() == before
    res = mnt.rewrite_bins(spark, path, plan, ["l_returnflag"], dry_run=False)
    after = mnt.file_inventory(spark, path).count()
    assert res.files_removed == before and after < before
    back = spark.read.parquet(path).select(*li.columns)
    assert back.exceptAll(li).count() == 0 and li.exceptAll(back).count() == 0


def test_expiry_retain_last_matches_brute_force(spark):
    ev = fx.read_table(spark, SF_MID, "events")
    cutoff = dt.datetime(2024, 1, 20)
    got = mnt.expired_snapshots(ev, table_cols=["user_id"], time_col="ts", id_col="event_id",
                                older_than=cutoff, retain_last=3).select("event_id")
    w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    want = ev.withColumn("rk", F.row_number().over(w)).where(
        (F.col("rk") > 3) & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))).select("event_id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_expiry_uses_a_partial_group_limit(spark):
    ev = fx.read_table(spark, SF_MID, "events")
    df = mnt.expired_snapshots(ev, table_cols=["user_id"], time_col="ts", id_col="event_id",
                               older_than=dt.datetime(2024, 1, 26))
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_orphans_respect_age(spark):
    listing = spark.createDataFrame([("a", 1), ("b", 5), ("c", 9)], "path string, age long")
    ref = spark.createDataFrame([("a",)], "path string")
    got = mnt.orphan_files(listing, ref, on="path", modified_col="age", older_than=6)
    assert [r.path for r in got.collect()] == ["b"]


def test_sweep_excludes_and_stops_a_table_after_a_failure(spark):
    db = "t_sweep"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'wh')}'")
    for name in ("good", "bad", "x_d1_y"):
        spark.range(10).write.saveAsTable(f"{db}.{name}")

    class Backend:
        def run(self, step, database, table):
            if table == "bad" and step == "rewrite_manifests":
                raise RuntimeError("nope")
            return "SUCCESS"

    rows = {(r.TABLE_NAME, r.STEP): r.STATUS for r in mnt.sweep(spark, [db], Backend()).collect()}
    assert rows[("x_d1_y", None)] == "EXCLUDED"
    assert rows[("bad", "rewrite_data_files")] == "SUCCESS"
    assert rows[("bad", "rewrite_manifests")] == "FAILED"
    assert rows[("bad", "expire_snapshots")] == "NOT_RUN"
    assert all(rows[("good", s)] == "SUCCESS" for s in mnt.STEPS)
    names = spark.createDataFrame([(n,) for n in mnt.list_tables(spark, db)], "name string")
    assert sorted(r.name for r in mnt.without_excluded(names).collect()) == ["bad", "good"]


def test_a_file_over_the_maximum_is_split(spark):
    li = fx.read_table(spark, SF_MID, "lineitem")
    path = scratch_path(spark, "t-big")
    # one file written with small row groups, so the scan can split it
    li.coalesce(1).write.option("parquet.block.size", 64 * 1024).parquet(path)
    inv = mnt.file_inventory(spark, path)
    size = inv.first()["size"]
    target = size // 4
    plan = mnt.compaction_plan(inv, partition_cols=[], order_col="modified", tie_cols=["path"],
                               target_bytes=target)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target))
    try:
        mnt.rewrite_bins(spark, path, plan, [], dry_run=False, target_bytes=target)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert mnt.file_inventory(spark, path).count() >= 3
    back = spark.read.parquet(path)
    assert back.exceptAll(li).count() == 0 and li.exceptAll(back).count() == 0


def test_rewrite_in_several_jobs_keeps_rows(spark):
    li = fx.read_table(spark, SF_MID, "lineitem")
    path = scratch_path(spark, "t-jobs")
    li.repartition(24).write.partitionBy("l_returnflag").parquet(path)
    inv = mnt.file_inventory(spark, path)
    target = int(inv.agg(F.sum("size")).first()[0] // 12)
    plan = mnt.compaction_plan(inv, partition_cols=["l_returnflag"], order_col="modified",
                               tie_cols=["path"], target_bytes=target)
    res = mnt.rewrite_bins(spark, path, plan, ["l_returnflag"], dry_run=False,
                           max_bins_per_job=2, target_bytes=target)
    assert res.bins >= 6 and res.files_removed == 72
    back = spark.read.parquet(path).select(*li.columns)
    assert back.exceptAll(li).count() == 0 and li.exceptAll(back).count() == 0


def test_running_sum_with_null_order_values_and_one_chunk(spark):
    df = spark.createDataFrame([("a", None, 1, 5), ("a", 3, 2, 7), ("b", None, 3, 2), ("b", None, 4, 4)],
                               "g string, o long, tie long, v long")
    for chunks in (1, 4):
        got = {r.tie: r.rs for r in grouped_running_sum(df, ["g"], "o", "v", "rs",
                                                        tie_cols=["tie"], chunks=chunks).collect()}
        assert got == {1: 0, 2: 5, 3: 0, 4: 2}


def test_default_cutoffs_follow_the_clock(spark):
    now = dt.datetime.now()
    snaps = spark.createDataFrame(
        [(1, 1, now - dt.timedelta(days=10)), (1, 2, now - dt.timedelta(days=9)),
         (1, 3, now - dt.timedelta(days=1))], "t long, id long, at timestamp_ntz")
    got = [r.id for r in mnt.expired_snapshots(snaps, table_cols=["t"], time_col="at",
                                               id_col="id").collect()]
    assert sorted(got) == [1, 2]          # older than 5 days and not the newest
    files = spark.createDataFrame([("old", now - dt.timedelta(days=4)), ("new", now)],
                                  "path string, modified timestamp_ntz")
    none = spark.createDataFrame([], "path string")
    got = [r.path for r in mnt.orphan_files(files, none, on="path", modified_col="modified").collect()]
    assert got == ["old"]


def test_procedure_calls_reject_odd_names(spark):
    with pytest.raises(ValueError):
        mnt.IcebergProcedures(spark, "cat").run("expire_snapshots", "db", "t'); DROP TABLE x; --")


def test_stale_write_leftovers_are_found_and_removed(spark):
    db = "t_leftovers"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'wh')}'")
    spark.range(100).write.saveAsTable(f"{db}.t")
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.t").where(F.col("col_name") == "Location") \
        .first()["data_type"]
    jvm = spark.sparkContext._jvm
    fs, _ = mnt._fs(spark, loc)
    old_dir = jvm.org.apache.hadoop.fs.Path(f"{loc}/_temporary/0")
    new_dir = jvm.org.apache.hadoop.fs.Path(f"{loc}/.spark-staging-fresh")
    fs.mkdirs(old_dir)
    fs.mkdirs(new_dir)
    ten_days_ago = jvm.java.lang.System.currentTimeMillis() - 10 * 86400 * 1000
    fs.setTimes(jvm.org.apache.hadoop.fs.Path(f"{loc}/_temporary"), ten_days_ago, -1)
    assert [p.rsplit("/", 1)[-1] for p in mnt.stale_write_leftovers(spark, loc)] == ["_temporary"]
    backend = mnt.ParquetMaintenance(spark, dry_run=False)
    assert backend.run("remove_orphan_files", db, "t") == "SUCCESS"
    assert not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{loc}/_temporary"))
    assert fs.exists(new_dir) and spark.table(f"{db}.t").count() == 100


def test_compaction_holds_no_task_whole(spark, monkeypatch):
    """Rewrites are written without a sort by partition value, and a file over the maximum is read in splits."""
    path = scratch_path(spark, "t-unsorted")
    for m, n in (("a", 3000), ("b", 3000), ("big", 60_000)):
        spark.range(n).select(F.col("id"), F.lit(m).alias("m")).repartition(1 if m == "big" else 6) \
            .write.mode("append").option("parquet.block.size", 32 * 1024).partitionBy("m").parquet(path)
    written, swap = [], mnt._swap
    monkeypatch.setattr(mnt, "SPLIT_BYTES", 64 * 1024, raising=False)
    monkeypatch.setattr(mnt, "_swap", lambda spark, table, out, *rest: written.append(out) or swap(spark, table, out, *rest))
    inv = mnt.file_inventory(spark, path)
    plan = mnt.compaction_plan(inv, partition_cols=["folder"], order_col="modified", tie_cols=["path"],
                               target_bytes=100_000)
    mnt.rewrite_bins(spark, path, plan, ["m"], dry_run=False, target_bytes=100_000)
    assert {(r.m, r["count"]) for r in spark.read.parquet(path).groupBy("m").count().collect()} == {
        ("a", 3000), ("b", 3000), ("big", 60_000)}
    spark.sql("DROP TABLE IF EXISTS t_unsorted")
    spark.sql(f"CREATE TABLE t_unsorted (id BIGINT, m STRING) USING parquet PARTITIONED BY (m) "
              f"LOCATION '{scratch_path(spark, 't-unsorted-table')}'")
    try:
        for out in written:
            out.createOrReplaceGlobalTempView("t_unsorted_rows")
            insert = "EXPLAIN INSERT INTO t_unsorted SELECT id, m FROM global_temp.t_unsorted_rows"
            assert "Sort [m" in spark.sql(insert).first()[0] and "Sort [m" not in out.sparkSession.sql(insert).first()[0]
    finally:
        spark.sql("DROP TABLE t_unsorted")
    assert written
