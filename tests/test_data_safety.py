"""Inputs on which a load or a compaction could lose, keep or hide rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops import jobs
from lakeops.operators import maintenance as mnt
from lakeops.operators.control import ControlEntry
from lakeops.operators.ingest import LakeLocation, load_full, load_incremental, load_merge, run_ingestion
from lakeops.operators.reconcile import plan_reconcile, run_reconcile
from lakeops.session import scratch_path
from lakeops.sources.lake import LakeTables, SparkSources
from lakeops.streaming.file_drop import ingest_drops


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


@pytest.fixture
def lake(spark):
    return LakeLocation(spark, root=scratch_path(spark, "t-safe"))


@pytest.fixture
def database(spark):
    name = "t_safe_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'wh')}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_merge_keeps_rows_of_the_null_partition(spark, lake):
    ddl = "k long, p string, v string"
    load_full(spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "x", "c")], ddl), lake, "t", ["p"])
    load_merge(spark.createDataFrame([(1, None, "A"), (3, "x", "C")], ddl), lake, "t", ["k"])
    assert rows_of(lake.read("t"), "k", "p", "v") == [(1, None, "A"), (2, None, "b"), (3, "x", "C")]


def test_merge_into_null_partitions_only(spark, lake):
    ddl = "k long, p string, v string"
    load_full(spark.createDataFrame([(1, None, "a"), (2, "y", "b")], ddl), lake, "t", ["p"])
    load_merge(spark.createDataFrame([(1, None, "A"), (5, None, "n")], ddl), lake, "t", ["k"])
    assert rows_of(lake.read("t"), "k", "p", "v") == [(1, None, "A"), (2, "y", "b"), (5, None, "n")]


def test_key_that_leaves_a_partition_with_a_space(spark, lake):
    ddl = "k long, p string"
    load_full(spark.createDataFrame([(1, "a b"), (2, "c%d")], ddl), lake, "t", ["p"])
    load_merge(spark.createDataFrame([(1, "z"), (2, "z")], ddl), lake, "t", ["k"])
    assert rows_of(lake.read("t"), "k", "p") == [(1, "z"), (2, "z")]


def test_merge_of_a_partition_that_is_spelled_otherwise(spark, lake):
    # Readers see both m=01 and m=1 as the number 1.
    load_full(spark.createDataFrame([(1, "01"), (2, "1")], "k long, m string"), lake, "t", ["m"])
    load_merge(spark.createDataFrame([(1, 1)], "k long, m int"), lake, "t", ["k"])
    assert rows_of(lake.read("t"), "k", "m") == [(1, 1), (2, 1)]


def test_control_driven_merge_takes_the_newest_version(spark, lake):
    ddl = "k long, at timestamp_ntz, v string"
    load_full(spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "old")], ddl), lake, "t")
    spark.createDataFrame([(1, dt.datetime(2024, 3, 1), "newest"), (1, dt.datetime(2024, 2, 1), "newer")], ddl) \
        .createOrReplaceTempView("merge_newest")
    e = ControlEntry(1, 1, "SELECT * FROM merge_newest", "x", "t", "merge", dt.datetime(2024, 1, 15), "at",
                     merge_key="k")
    run = run_ingestion(spark, [e], SparkSources(spark), lake, job_name="J", batch="B")
    assert rows_of(lake.read("t"), "v") == [("newest",)] and run.marks[1] == dt.datetime(2024, 3, 1)


def test_several_mark_columns_and_placeholders(spark, lake):
    ddl = "k long, changed timestamp_ntz, made timestamp_ntz"
    d = dt.datetime
    spark.createDataFrame([(1, d(2024, 1, 1), d(2023, 1, 1)), (2, None, d(2024, 5, 1)), (3, d(2024, 6, 1), None),
                           (4, d(2024, 1, 1), d(2024, 9, 1))], ddl).createOrReplaceTempView("two_marks")
    text = "SELECT * FROM two_marks WHERE coalesce(changed, made) > {startdatetime}"
    e = ControlEntry(1, 1, text, "x", "t", "incremental", d(2024, 2, 1), "changed, made")
    run = run_ingestion(spark, [e], SparkSources(spark), lake, job_name="J", batch="B")
    assert rows_of(lake.read("t"), "k") == [(2,), (3,)] and run.marks[1] == d(2024, 6, 1)
    plan = plan_reconcile(spark, [e], SparkSources(spark), LakeTables(spark))
    assert "base_query" in plan.failed[0]


def test_control_driven_loads_keep_a_catalog_tables_layout(spark, database):
    where = LakeLocation(spark, database=database)
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "b", 1)], "k long, p string, v long")
    for t in ("full", "inc", "mrg"):
        base.write.partitionBy("p").saveAsTable(f"{database}.{t}")
        spark.sql(f"ALTER TABLE {database}.{t} SET TBLPROPERTIES ('owner_team' = 'it''s us')")
    spark.createDataFrame([(3, "a", 9), (4, "c", 9)], "k long, p string, v long").createOrReplaceTempView("layout_src")
    entries = [ControlEntry(1, 1, "SELECT * FROM layout_src", "x", "full", "Full Load"),
               ControlEntry(2, 1, "SELECT * FROM layout_src", "x", "inc", "incremental", None, "v", 5),
               ControlEntry(3, 1, "SELECT * FROM layout_src", "x", "mrg", "merge", None, "v", 5, merge_key="k")]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        run = run_ingestion(spark, entries, SparkSources(spark), where, job_name="J", batch="B")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert run.succeeded == 3
    new = [(3, "a", 9), (4, "c", 9)]
    assert rows_of(where.read("full"), "k", "p", "v") == new
    assert rows_of(where.read("inc"), "k", "p", "v") == sorted([(1, "a", 1), (2, "b", 1), (3, "b", 1), *new])
    assert rows_of(where.read("mrg"), "k", "p", "v") == [(1, "a", 1), (2, "b", 1), *new]
    for t in ("full", "inc", "mrg"):
        assert where.partitions(t) == ["p"]
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {database}.{t}").collect()}
        assert props["owner_team"] == "it's us"


def test_incremental_into_a_partitioned_folder_is_visible(spark, lake):
    ddl = "k long, p string"
    load_full(spark.createDataFrame([(1, "a")], ddl), lake, "t", ["p"])
    load_incremental(spark.createDataFrame([(2, "b")], ddl), lake, "t", "k", 1)
    assert rows_of(lake.read("t"), "k", "p") == [(1, "a"), (2, "b")] and lake.partitions("t") == ["p"]


def test_second_ingest_run_appends_nothing(spark, database):
    spark.range(10).createOrReplaceTempView("ten")
    spark.createDataFrame([(1, 1, "SELECT * FROM ten WHERE id > {offset_value}", "x", "s", "t", "incremental", None, "id",
                            4, 1, 1, 1, None)], "id long, groupid long, sql_query string, source string, schemaname string, "
                          "tablename string, loadtype string, startdatetime timestamp_ntz, data_validation_column string, "
                          "offset_value long, active int, data_validation_required int, priority int, merge_key string") \
        .write.saveAsTable(f"{database}.control")
    args = ["ingest", "--control", f"{database}.control", "--group", "1", "--lake-db", database]
    for _ in range(2):
        jobs.main(args)
        assert spark.table(f"{database}.t").count() == 5
    assert spark.table(f"{database}.control").first()["offset_value"] == 9
    assert spark.table(f"{database}.ingestion_audit").count() == 2


def test_running_sum_keeps_null_groups(spark):
    from lakeops.functions.running import grouped_running_sum
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 7)], "g string, o long, v long")
    assert rows_of(grouped_running_sum(df, ["g"], "o", "v", "rs"), "g", "o", "rs") == [("a", 1, 0), (None, 1, 0), (None, 2, 5)]


def test_running_sum_splits_rows_of_equal_order(spark):
    from lakeops.functions.running import grouped_running_sum
    df = spark.range(5000).select(F.lit("g").alias("g"), F.lit(1).alias("o"), F.col("id").alias("tie"), F.lit(1).alias("v"))
    got = grouped_running_sum(df, ["g"], "o", "v", "rs", tie_cols=["tie"], chunks=8)
    assert got.where("rs <> tie").count() == 0 and got.count() == 5000


def _sweep(spark, path, parts, target, **kw):
    plan = mnt.compaction_plan(mnt.file_inventory(spark, path), partition_cols=["folder"], order_col="modified",
                               tie_cols=["path"], target_bytes=target)
    return mnt.rewrite_bins(spark, path, plan, parts, dry_run=False, target_bytes=target, **kw)


def test_compaction_of_a_catalog_table_with_an_added_column(spark, database):
    name = f"{database}.t"
    spark.sql(f"CREATE TABLE {name} (k BIGINT, m STRING) USING parquet PARTITIONED BY (m)")
    for i in range(4):
        spark.createDataFrame([(i, "01"), (i + 10, None)], "k long, m string").coalesce(1).write.insertInto(name)
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS (added STRING)")
    spark.createDataFrame([(50, "new", "01")], "k long, added string, m string").write.insertInto(name)
    before = rows_of(spark.table(name), "k", "m", "added")
    assert mnt.ParquetMaintenance(spark, target_bytes=1 << 20, dry_run=False).run(
        "rewrite_data_files", database, "t") == "SUCCESS"
    assert rows_of(spark.table(name), "k", "m", "added") == before and len(before) == 9
    loc = LakeLocation(spark, database=database).described("t", "Location")
    assert mnt.file_inventory(spark, loc).count() == 2


def test_compaction_converges(spark):
    path = scratch_path(spark, "t-conv")
    for i in range(6):
        spark.range(i * 1000, i * 1000 + 1000).coalesce(1).write.mode("append").parquet(path)
    size = max(r["size"] for r in mnt.file_inventory(spark, path).collect())
    target = int(size / 0.7)
    removed = [_sweep(spark, path, [], target).files_removed for _ in range(3)]
    assert removed[-1] == 0 and spark.read.parquet(path).count() == 6000
    lone = scratch_path(spark, "t-lone")
    spark.range(5).coalesce(1).write.parquet(lone)
    assert _sweep(spark, lone, [], 1 << 20).files_removed == 0


def test_compaction_refuses_a_table_that_a_stream_writes(spark):
    drops, out, ck = (scratch_path(spark, n) for n in ("d", "o", "ck"))
    spark.range(30).repartition(3).write.json(drops)
    assert ingest_drops(spark, drops, "json", "id long", out, ck) == 30
    with pytest.raises(ValueError, match="stream"):
        _sweep(spark, out, [], 1 << 20)
    assert spark.read.parquet(out).count() == 30


def test_a_swap_that_broke_off_is_finished_or_undone(spark):
    path = scratch_path(spark, "t-swap")
    spark.range(100).repartition(4).write.parquet(path)
    old = [r["path"] for r in mnt.file_inventory(spark, path).collect()]
    fs, _ = mnt._fs(spark, path)
    ready = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name, marked in (("undone", False), ("done", True)):
        folder = f"{path}/{mnt.SWAP_PREFIX}{name}"
        spark.read.parquet(*old).coalesce(1).write.parquet(f"{folder}/new")
        spark.createDataFrame([(p,) for p in old], "path string").write.parquet(f"{folder}/old")
        if marked:
            fs.create(ready(f"{folder}/ready")).close()
        assert spark.read.parquet(path).count() == 100  # out of readers' sight
    assert mnt.finish_swaps(spark, path) == 1 and mnt.finish_swaps(spark, path) == 0
    assert spark.read.parquet(path).count() == 100 and mnt.file_inventory(spark, path).count() == 1


def test_stream_counts_every_batch(spark):
    drops, out, ck = (scratch_path(spark, n) for n in ("d", "o", "ck"))
    spark.range(130).repartition(130).write.json(drops)
    assert ingest_drops(spark, drops, "json", "id long", out, ck, max_files_per_trigger=1) == 130
    assert spark.read.parquet(out).count() == 130


def test_whole_table_counts_do_not_unfilter_the_others(spark):
    spark.range(1000).write.mode("overwrite").parquet(path := scratch_path(spark, "t-footer"))
    spark.read.parquet(path).createOrReplaceTempView("footer_src")
    entries = [ControlEntry(1, 1, "SELECT * FROM footer_src", "x", "footer_src", "Full Load"),
               ControlEntry(2, 1, "SELECT * FROM footer_src", "x", "footer_src", "merge", None, "id", 100)]
    from lakeops.operators.reconcile import counts_frame
    plan = plan_reconcile(spark, entries, SparkSources(spark), LakeTables(spark))
    told = counts_frame(plan.specs)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), LessThanOrEqual(id,100)]" in told and "ReadSchema: struct<>" in told
    got = {r.ID: (r.SOURCE_COUNT, r.DATALAKE_COUNT) for r in run_reconcile(
        spark, entries, SparkSources(spark), LakeTables(spark), job_name="J", batch="B").audit.collect()}
    assert got == {1: (1000, 1000), 2: (101, 1000)}


def test_coalesced_lake_window_is_pushed(spark):
    from lakeops.functions.predicates import lake_window, ts_literal
    path = scratch_path(spark, "t-push")
    spark.range(10).select(*[F.lit("2024-01-01").cast("timestamp_ntz").alias(c) for c in "ab"]).write.parquet(path)
    df = spark.read.parquet(path).where(lake_window(["a", "b"], ts_literal("2024-01-10")))
    assert "PushedFilters: [Or(" in df._jdf.queryExecution().executedPlan().toString()


def test_more_predicates_than_one_aggregate_holds(spark):
    spark.range(500).createOrReplaceTempView("wide_src")
    entries = [ControlEntry(i, 1, "SELECT * FROM wide_src", "x", "wide_src", "merge", None, "id", i) for i in range(-1, 150)]
    res = run_reconcile(spark, entries, SparkSources(spark), LakeTables(spark), job_name="J", batch="B")
    assert {r.ID: r.SOURCE_COUNT for r in res.audit.collect()} == {i: i + 1 for i in range(-1, 150)}


def test_scratch_is_refused_on_a_cluster_without_a_shared_folder(monkeypatch):
    from lakeops import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="share"):
        session.scratch_root(Session())
