"""Queries over loads that break: a failing source, a driver lost between two steps, a repeated run.

Each breaks a load of the given tables on purpose, calls it again as the next run would,
and returns what is in the lake then; the SQL twins know nothing of the break.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops import jobs
from lakeops.functions.predicates import ts_literal
from lakeops.operators.audit import append_audit, read_audit
from lakeops.operators.control import CONTROL_SCHEMA, ControlEntry
from lakeops.operators.ingest import LakeLocation, load_full, load_merge, run_ingestion
from lakeops.operators.ledger import COMMIT, LoadLedger
from lakeops.operators.publish import Files
from lakeops.operators.reconcile import reconcile_frame
from lakeops.plans import catalogue as cat
from lakeops.plans import fixtures as fx
from lakeops.session import scratch_path
from lakeops.sources.files import write_drop
from lakeops.sources.lake import SparkSources
from lakeops.streaming.file_drop import DropLoads

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str):
    def register(fn):
        QUERIES[name], ORACLE[name] = fn, oracle
        return fn
    return register


class DriverLost(Exception):
    """Stands in for a driver that dies at this step."""


def dying_at(table: str, step: str, skip: int = 0) -> Callable[[str, str], None]:
    """A watch that dies when ``table`` reaches a step of that name, after ``skip`` of them."""
    left = [skip]

    def watch(of: str, at: str) -> None:
        if of == table and at.startswith(step):
            if left[0] == 0:
                raise DriverLost(f"{of}: {at}")
            left[0] -= 1

    return watch


# ------------------------------------------------------------------ ING-1
PLACES = ("folder", "managed", "external")


def _state(df: DataFrame, place: str, phase: str, kept) -> DataFrame:
    return df.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")).select(
        F.lit(place).alias("place"), F.lit(phase).alias("phase"), "o_orderpriority", "n", "keys",
        F.lit(kept).alias("layout_kept"))


@query("load_full_failed", "\nUNION ALL\n".join(
    f"SELECT '{place}' AS place, '{phase}' AS phase, o_orderpriority, count(*) AS n, "
    f"CAST(sum(o_orderkey) AS BIGINT) AS keys, TRUE AS layout_kept FROM {table} t GROUP BY o_orderpriority"
    for place in PLACES for phase, table in (("source failed", cat.S_ORDERS_LAKE), ("loaded", "orders"))))
def q_load_full_failed(spark, sf_dir):
    """ING-1: an extract that raises half-way leaves the old rows; a good load then replaces them.
    In a folder, a managed and an external catalog table, whose place, type, comment and properties stay."""
    fx.register(spark, sf_dir)
    orders = fx.read_table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    broken = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("source lost")).cast("bigint"))
                               .otherwise(F.col("o_custkey").cast("bigint")).cast(orders.schema["o_custkey"].dataType))
    root = scratch_path(spark, "full-failed")
    database = "full_failed_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    out = []
    for place in PLACES:
        lake = LakeLocation(spark, root=f"{root}/lake") if place == "folder" else LakeLocation(spark, database=database)
        old = spark.table("orders_lake")
        if place == "folder":
            load_full(old, lake, place)
        else:
            writer = old.write.format("parquet").partitionBy("o_orderstatus")
            if place == "external":
                writer = writer.option("path", f"{root}/outside")
            writer.saveAsTable(lake.name(place))
            spark.sql(f"COMMENT ON TABLE {lake.name(place)} IS 'orders, as loaded'")
            spark.sql(f"ALTER TABLE {lake.name(place)} SET TBLPROPERTIES ('owner_team' = 'lake')")

        def layout():
            if place == "folder":
                return None
            about = lake.details(place)
            return [about.get(k) for k in ("Location", "Type", "Provider", "Comment")] + [lake.partitions(place),
                                                                                          lake._properties(place)]

        before = layout()
        try:
            load_full(broken, lake, place)
            raise AssertionError("the extract should have failed")
        except AssertionError:
            raise
        except Exception:  # noqa: BLE001 - the source's own error
            pass
        # What is there now is written down before the next load replaces it.
        path = scratch_path(spark, "full-failed-state")
        _state(lake.read(place), place, "source failed", layout() == before).write.parquet(path)
        out.append(spark.read.parquet(path))
        load_full(orders, lake, place)
        out.append(_state(lake.read(place), place, "loaded", layout() == before))
    return reduce(DataFrame.unionByName, out)


# ------------------------------------------------------------------ ING-2, ING-4, SNK-4
_RERUN = {"lineitem": cat.S_LINEITEM_INC, "events": cat.S_EVENTS_INC, "orders_merged": cat.S_ORDERS_MERGED}
_RERUN_KEYS = {"lineitem": "l_orderkey * 10 + l_linenumber", "events": "event_id", "orders_merged": "o_orderkey"}


@query("ingestion_rerun", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n, count(DISTINCT {_RERUN_KEYS[t]}) AS n_keys, "
    f"CAST(sum({_RERUN_KEYS[t]}) AS BIGINT) AS keys, CAST({failed} AS BIGINT) AS failed_audits, "
    f"CAST({2 - failed} AS BIGINT) AS successful_audits, CAST(2 AS BIGINT) AS commits FROM ({sql}) t"
    for (t, sql), failed in zip(_RERUN.items(), (1, 0, 0))))
def q_ingestion_rerun(spark, sf_dir):
    """ING-2 + ING-4 + SNK-4: a control group is run twice from the same control rows, as after a lost
    driver.  In the first run the driver dies when one table's rows are in place but nothing knows it yet,
    and the marks of the others are not saved; the tables end up as from one run, and the audit holds each
    run's row of each table once."""
    fx.register(spark, sf_dir)
    root = scratch_path(spark, "rerun")
    lake = LakeLocation(spark, root=root)
    li = fx.read_table(spark, sf_dir, "lineitem")
    load_full(fx.lineitem_lake(li).where(F.col("l_shipdate") <= ts_literal(cat._MARK_2001)), lake, "lineitem", ["l_returnflag"])
    load_full(fx.events_lake(fx.read_table(spark, sf_dir, "events")), lake, "events")
    load_full(spark.table("orders_lake"), lake, "orders_merged", ["o_orderstatus"])
    entries = [e for e in cat.ingestion_control(spark, sf_dir) if e.tablename in _RERUN]
    control = spark.createDataFrame([tuple(
        {"active": 1, "data_validation_required": 1, "schemaname": "s"}.get(f.name, getattr(e, f.name, None))
        for f in CONTROL_SCHEMA) for e in entries], CONTROL_SCHEMA)
    audit = f"{root}/_audit"
    for turn in range(2):
        at = dataclasses.replace(lake, watch=dying_at("lineitem", "note")) if turn == 0 else lake
        jobs.ingest(spark, control, 1, at, job_name="J", audit_target=audit, sources=SparkSources(spark), batch=f"{turn}_1")
    told = read_audit(spark, audit).groupBy(F.col("TABLE_NAME").alias("table_name")).agg(
        F.count_if(F.col("STATUS") == "FAILED").alias("failed_audits"),
        F.count_if(F.col("STATUS") == "SUCCESS").alias("successful_audits"))
    commits = (LoadLedger(spark, lake.path("_load_ledger")).read().where(F.col("STATE") == COMMIT)
               .groupBy(F.col("TABLE_NAME").alias("table_name")).agg(F.count(F.lit(1)).alias("commits")))
    sizes = reduce(DataFrame.unionByName, [
        lake.read(t).select(F.expr(k).cast("bigint").alias("k")).agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("n_keys"), F.sum("k").alias("keys"))
        .select(F.lit(t).alias("table_name"), "n", "n_keys", "keys") for t, k in _RERUN_KEYS.items()])
    return sizes.join(told, "table_name").join(commits, "table_name")


# ------------------------------------------------------------------ ING-3, SNK-3
@query("load_merge_interrupted", f"""
SELECT *, TRUE AS was_interrupted FROM ({cat.S_ORDERS_MERGED}) m""")
def q_load_merge_interrupted(spark, sf_dir):
    """ING-3 + SNK-3: the driver dies after the first of the touched partitions is swapped in; the next
    call finishes the rest from the publication record."""
    fx.register(spark, sf_dir)
    root = scratch_path(spark, "interrupted")
    dying = LakeLocation(spark, root=root, watch=dying_at("orders", "swap", skip=1))
    load_full(spark.table("orders_lake"), dying, "orders", ["o_orderpriority"])
    try:
        load_merge(spark.sql(cat.ORDERS_UPD_SQL), dying, "orders", ["o_orderkey"], "o_orderdate", cat._MARK_2001)
        interrupted = False
    except DriverLost:
        interrupted = True
    lake = LakeLocation(spark, root=root)
    interrupted = lake.finish("orders") is not None and interrupted
    return lake.read("orders").withColumn("was_interrupted", F.lit(interrupted))


# ------------------------------------------------------------------ SNK-1
@query("audit_append_once", f"SELECT *, CAST(1 AS BIGINT) AS times FROM ({cat.ORACLE_BATCH}) b")
def q_audit_append_once(spark, sf_dir):
    """SNK-1: a batch whose audit rows are appended twice is in the audit once; another batch is not touched."""
    fx.register(spark, sf_dir)
    target = scratch_path(spark, "audit-once")
    rows = reconcile_frame(spark, cat.batch_plan(spark, sf_dir), cat.JOB_NAME, cat.BATCH)
    append_audit(rows.withColumn("BATCH_NUMBER", F.lit("another")), target)
    for _ in range(2):
        append_audit(rows, target)
    mine = read_audit(spark, target).where(F.col("BATCH_NUMBER") == cat.BATCH)
    return mine.groupBy(*cat.BATCH_COLS).agg(F.count(F.lit(1)).alias("times"))


# ------------------------------------------------------------------ SRC-9
_DROPPED = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * {times} AS o_totalprice, o_orderdate, "
            "o_orderpriority, CAST({version} AS INTEGER) AS version FROM orders").format


@query("file_drop_control", "\nUNION ALL\n".join([
    "SELECT 'appended' AS how, * FROM (" + _DROPPED(times=1, version=1) + ") a",
    "SELECT 'appended' AS how, * FROM (" + _DROPPED(times=2, version=2) + ") a WHERE o_orderkey % 3 = 0",
    "SELECT 'merged' AS how, * FROM (" + _DROPPED(times=1, version=1) + ") a WHERE o_orderkey % 3 <> 0",
    "SELECT 'merged' AS how, * FROM (" + _DROPPED(times=2, version=2) + ") a WHERE o_orderkey % 3 = 0"]))
def q_file_drop_control(spark, sf_dir):
    """SRC-9 by control rows: two drops of files, appended to one table and merged by key into another, each file
    read once.  The stream's record of the second batch is lost before the last run, so that batch is replayed."""
    fx.register(spark, sf_dir)
    root = scratch_path(spark, "drop-control")
    lake, drops = LakeLocation(spark, root=f"{root}/lake"), f"{root}/drops"
    ledger = LoadLedger(spark, lake.path("_load_ledger"))
    entries = [ControlEntry(i, 2, drops, "parquet", how, load, None, "version" if load == "merge" else None, priority=i,
                            merge_key="o_orderkey" if load == "merge" else None)
               for i, (how, load) in enumerate((("appended", "incremental"), ("merged", "merge")), 1)]
    sources = DropLoads(spark, lake, ledger)
    # Numbers of batches follow the drops: one a run.
    for turn, (times, where) in enumerate(((1, "true"), (2, "o_orderkey % 3 = 0"), (0, None))):
        if where:
            write_drop(spark.sql(_DROPPED(times=times, version=times)).where(where), drops, "parquet")
        else:
            for e in entries:
                Files(spark).delete(f"{sources.checkpoints}/{e.id}-{e.tablename}/commits/1")
        run = run_ingestion(spark, entries, sources, lake, job_name="J", batch=f"{turn}_2", ledger=ledger)
        if run.failed:
            raise RuntimeError(run.audit.where("STATUS = 'FAILED'").first()["ERROR_MESSAGE"])
    return reduce(DataFrame.unionByName, [lake.read(e.tablename).withColumn("how", F.lit(e.tablename)) for e in entries])
