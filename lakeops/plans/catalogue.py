"""Registered queries and their DuckDB oracle SQL.

Every query reads the given tables (or relations Spark derives from them),
so its work grows with the data.  Each has an SQL twin computing the same
result on the same Parquet files, with identical column names.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.formatting import batch_number, hms_words
from lakeops.functions.predicates import (lake_window, source_window, split_columns,
                                          ts_literal)
from lakeops.operators.audit import append_audit, append_rows, read_audit
from lakeops.operators.control import (CONTROL_SCHEMA, ControlEntry, control_scan,
                                       to_entries)
from lakeops.operators.ingest import (LakeLocation, load_full, load_incremental, load_merge,
                                      overwrite_partitions, run_ingestion)
from lakeops.operators.maintenance import (ParquetMaintenance, compaction_plan,
                                           compaction_schema, expired_snapshots, file_inventory, list_tables,
                                           orphan_files, rewrite_bins, sweep, unsorted_writes, without_excluded)
from lakeops.operators.reconcile import plan_reconcile, reconcile_frame, run_reconcile
from lakeops.plans import fixtures as fx
from lakeops.session import scratch_path
from lakeops.sources.files import read_dropped, write_drop
from lakeops.sources.lake import LakeTables, SparkSources
from lakeops.streaming.file_drop import ingest_drops

JOB_NAME = "LAKE_DATA_VALIDATION"
BATCH = "1733011200_1"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return wrap


# --------------------------------------------------------------------------- SQL twins
S_ORDERS_LAKE = "(SELECT * FROM orders WHERE o_orderkey % 50 <> 7)"
S_LINEITEM_LAKE = "(SELECT * FROM lineitem WHERE (l_orderkey * 7 + l_linenumber) % 101 <> 3)"
S_OFF = "(SELECT CAST(FLOOR(COUNT(*) * 0.75) AS BIGINT) FROM events)"
S_EVENTS_LAKE = f"(SELECT * FROM events WHERE event_id <= {S_OFF} AND event_id % 40 <> 3)"
S_EVENTS_SRC = ("(SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 "
                "THEN 'bad' ELSE CAST(ts + INTERVAL 1 DAY AS VARCHAR) END AS modified_on, "
                "CAST(ts AS VARCHAR) AS created_on FROM events)")
S_EVENTS_SRC_LAKE = (f"(SELECT event_id, TRY_CAST(modified_on AS TIMESTAMP) AS modified_on, "
                     f"TRY_CAST(created_on AS TIMESTAMP) AS created_on FROM {S_EVENTS_SRC} s "
                     f"WHERE event_id % 40 <> 3)")


def s_ms(x: str) -> str:
    """Millisecond rounding, half up, in DuckDB."""
    us = f"(epoch_us({x}) + 500)"
    return f"make_timestamp({us} - ({us} % 1000))"


def s_win(v: str, mark: str, upper: bool = True) -> str:
    lo = f"{v} > TIMESTAMP '{mark}' - INTERVAL 30 DAY"
    return f"({lo} AND {v} <= TIMESTAMP '{mark}')" if upper else f"({lo})"


S_SRC_MS = ("COALESCE(" + s_ms("TRY_CAST(modified_on AS TIMESTAMP)") + ", "
            + s_ms("TRY_CAST(created_on AS TIMESTAMP)") + ")")


def s_counts(table: str, load: str, src: str, lake: str) -> str:
    return (f"SELECT '{table}' AS TABLE_NAME, '{load}' AS LOAD_TYPE, s AS SOURCE_COUNT, "
            f"l AS DATALAKE_COUNT, s - l AS COUNT_DIFF FROM (SELECT ({src}) AS s, ({lake}) AS l) c")


# --------------------------------------------------------------------------- reconcile
RECONCILE_COLS = ["TABLE_NAME", "LOAD_TYPE", "SOURCE_COUNT", "DATALAKE_COUNT", "COUNT_DIFF"]


def _single(spark: SparkSession, sf_dir: str, entry: ControlEntry, **kw) -> DataFrame:
    fx.register(spark, sf_dir)
    plan = plan_reconcile(spark, [entry], SparkSources(spark), LakeTables(spark), **kw)
    if plan.failed:
        raise RuntimeError(plan.failed)
    return reconcile_frame(spark, plan, JOB_NAME, BATCH).select(*RECONCILE_COLS)


@query("reconcile_full_load", s_counts(
    "orders_lake", "Full Load", "SELECT count(*) FROM orders",
    f"SELECT count(*) FROM {S_ORDERS_LAKE} t"))
def reconcile_full_load(spark, sf_dir):
    """REC-1: whole source vs whole lake table."""
    e = ControlEntry(1, 1, "SELECT * FROM orders", "oracle", "orders_lake", "Full Load")
    return _single(spark, sf_dir, e)


_G2_SRC = f"SELECT count(*) FROM lineitem WHERE {s_win('l_shipdate', '1998-12-01')}"


@query("reconcile_window", s_counts(
    "lineitem_lake", "incremental", _G2_SRC,
    f"SELECT count(*) FROM {S_LINEITEM_LAKE} t WHERE {s_win('l_shipdate', '1998-12-01', False)}"))
def reconcile_window(spark, sf_dir):
    """REC-3 on an Oracle-style source: bounded source window, open lake window."""
    e = ControlEntry(2, 1, "SELECT * FROM lineitem", "oracle", "lineitem_lake", "incremental",
                     dt.datetime(1998, 12, 1), "l_shipdate")
    return _single(spark, sf_dir, e)


@query("reconcile_window_symmetric", s_counts(
    "lineitem_lake", "incremental", _G2_SRC,
    f"SELECT count(*) FROM {S_LINEITEM_LAKE} t WHERE {s_win('l_shipdate', '1998-12-01')}"))
def reconcile_window_symmetric(spark, sf_dir):
    """REC-3 with the lake window bounded above as well."""
    e = ControlEntry(2, 1, "SELECT * FROM lineitem", "oracle", "lineitem_lake", "incremental",
                     dt.datetime(1998, 12, 1), "l_shipdate")
    return _single(spark, sf_dir, e, lake_upper_bound=True)


@query("reconcile_offset", s_counts(
    "events_lake", "Merge", f"SELECT count(*) FROM events WHERE event_id <= {S_OFF}",
    f"SELECT count(*) FROM {S_EVENTS_LAKE} t"))
def reconcile_offset(spark, sf_dir):
    """REC-2: source up to the numeric mark vs the whole lake table."""
    off = fx.events_offset_value(spark, sf_dir)
    e = ControlEntry(3, 1, "SELECT * FROM events", "mssql", "events_lake", "Merge",
                     dt.datetime(2024, 2, 9), "event_id", off)
    return _single(spark, sf_dir, e)


@query("reconcile_window_coalesce", s_counts(
    "events_src_lake", "merge",
    f"SELECT count(*) FROM {S_EVENTS_SRC} s WHERE {s_win(S_SRC_MS, '2024-02-09')}",
    f"SELECT count(*) FROM {S_EVENTS_SRC_LAKE} t WHERE "
    f"{s_win('COALESCE(modified_on, created_on)', '2024-02-09', False)}"))
def reconcile_window_coalesce(spark, sf_dir):
    """REC-3 on a generic source: text columns, first convertible one, millisecond precision."""
    e = ControlEntry(4, 1, "SELECT * FROM events_src", "mssql", "events_src_lake", "merge",
                     dt.datetime(2024, 2, 9), "modified_on, created_on")
    return _single(spark, sf_dir, e)


_EDGE_MARK = "2024-01-31"
# Distances from the mark (days, microseconds): on, just inside and just outside both bounds of the
# 30-day window, within and beyond half a millisecond; then a value that does not parse, and NULL.
EDGES = [(-30, -600), (-30, -400), (-30, -1), (-30, 0), (-30, 1), (-30, 400), (-30, 600), (-30, 1000),
         (0, -600), (0, -1), (0, 0), (0, 1), (0, 400), (0, 600), (10, 0)]
_EDGE_CASES = " ".join(f"WHEN {i} THEN CAST(TIMESTAMP '{_EDGE_MARK}' + INTERVAL ({d}) DAY + INTERVAL ({us}) MICROSECOND "
                       f"AS VARCHAR)" for i, (d, us) in enumerate(EDGES))
S_EDGES = (f"(SELECT event_id, event_id % {len(EDGES) + 2} AS edge, CASE event_id % {len(EDGES) + 2} {_EDGE_CASES} "
           f"WHEN {len(EDGES)} THEN 'bad' END AS c, CASE WHEN event_id % 2 = 0 THEN 'none' END AS m FROM events)")


@query("window_boundaries", f"""
SELECT edge, in_source_micros, in_source_millis, in_lake_open, CAST(count(*) AS BIGINT) AS n
FROM (SELECT edge,
  COALESCE({s_win('COALESCE(m, c)', _EDGE_MARK)}, FALSE) AS in_source_micros,
  COALESCE({s_win('COALESCE(' + s_ms('m') + ', ' + s_ms('c') + ')', _EDGE_MARK)}, FALSE)
    AS in_source_millis,
  COALESCE({s_win('COALESCE(m, c)', _EDGE_MARK, False)}, FALSE) AS in_lake_open
  FROM (SELECT edge, TRY_CAST(m AS TIMESTAMP) AS m, TRY_CAST(c AS TIMESTAMP) AS c
        FROM {S_EDGES} s) x) y
GROUP BY 1, 2, 3, 4""")
def window_boundaries(spark, sf_dir):
    """FLT-2, FLT-3 and FLT-4 side by side on every event, moved to the bounds of the window.

    Values within half a millisecond of a bound fall differently under micro and
    milli precision; rows after the mark only pass the open lake window.
    """
    number = F.col("event_id") % (len(EDGES) + 2)
    mark = ts_literal(_EDGE_MARK)
    moved = F.lit(None).cast("string")
    for i, (days, micros) in enumerate(EDGES):
        at = mark + F.make_dt_interval(F.lit(days), secs=F.lit(micros / 1e6).cast("decimal(18,6)"))
        moved = F.when(number == i, at.cast("string")).otherwise(moved)
    src = fx.read_table(spark, sf_dir, "events").select(
        number.alias("edge"), F.when(number == len(EDGES), F.lit("bad")).otherwise(moved).alias("created_on"),
        F.when(F.col("event_id") % 2 == 0, F.lit("none")).alias("modified_on"))
    typed = src.select("edge", F.col("modified_on").try_cast("timestamp_ntz").alias("m"),
                       F.col("created_on").try_cast("timestamp_ntz").alias("c"),
                       "modified_on", "created_on")
    cols = split_columns("m, c")
    flags = typed.select(
        "edge",
        F.coalesce(source_window(cols, mark, "oracle"), F.lit(False)).alias("in_source_micros"),
        F.coalesce(source_window(["modified_on", "created_on"], mark, "generic"),
                   F.lit(False)).alias("in_source_millis"),
        F.coalesce(lake_window(cols, mark), F.lit(False)).alias("in_lake_open"))
    return flags.groupBy("edge", "in_source_micros", "in_source_millis", "in_lake_open").agg(
        F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- batch
BATCH_COLS = ["ID", "JOB_NAME", "GROUPID", "TABLE_NAME", "LOAD_TYPE", "INCREMENTAL_COLUMN",
              "SOURCE_COUNT", "DATALAKE_COUNT", "COUNT_DIFF", "STARTDATETIME", "START_OFFSET",
              "STATUS", "BATCH_NUMBER"]


def _batch_row(i, table, load, col, src, lake, start, offset, status="SUCCESS") -> str:
    col_sql = "NULL" if col is None else f"'{col}'"
    if status == "SUCCESS":
        counts = f"({src}) AS SOURCE_COUNT, ({lake}) AS DATALAKE_COUNT, ({src}) - ({lake}) AS COUNT_DIFF"
    else:
        counts = ("CAST(NULL AS BIGINT) AS SOURCE_COUNT, CAST(NULL AS BIGINT) AS DATALAKE_COUNT, "
                  "CAST(NULL AS BIGINT) AS COUNT_DIFF")
    return (f"SELECT CAST({i} AS BIGINT) AS ID, '{JOB_NAME}' AS JOB_NAME, CAST(1 AS BIGINT) AS GROUPID, "
            f"'{table}' AS TABLE_NAME, '{load}' AS LOAD_TYPE, CAST({col_sql} AS VARCHAR) AS INCREMENTAL_COLUMN, "
            f"{counts}, TIMESTAMP '{start}' AS STARTDATETIME, CAST({offset} AS BIGINT) AS START_OFFSET, "
            f"'{status}' AS STATUS, '{BATCH}' AS BATCH_NUMBER")


ORACLE_BATCH = "\nUNION ALL\n".join([
    _batch_row(1, "orders_lake", "Full Load", None, "SELECT count(*) FROM orders",
               f"SELECT count(*) FROM {S_ORDERS_LAKE} t", "1998-12-01", "NULL"),
    _batch_row(2, "lineitem_lake", "incremental", "l_shipdate", _G2_SRC,
               f"SELECT count(*) FROM {S_LINEITEM_LAKE} t WHERE {s_win('l_shipdate', '1998-12-01', False)}",
               "1998-12-01", "NULL"),
    _batch_row(3, "events_lake", "Merge", "event_id",
               f"SELECT count(*) FROM events WHERE event_id <= {S_OFF}",
               f"SELECT count(*) FROM {S_EVENTS_LAKE} t", "2024-02-09", S_OFF),
    _batch_row(4, "events_src_lake", "merge", "modified_on, created_on",
               f"SELECT count(*) FROM {S_EVENTS_SRC} s WHERE {s_win(S_SRC_MS, '2024-02-09')}",
               f"SELECT count(*) FROM {S_EVENTS_SRC_LAKE} t WHERE "
               f"{s_win('COALESCE(modified_on, created_on)', '2024-02-09', False)}",
               "2024-02-09", "NULL"),
    _batch_row(5, "no_such_table", "Full Load", None, None, None, "2024-02-09", "NULL", "FAILED"),
])


def batch_result(spark: SparkSession, sf_dir: str, mode: str = "joint", on_rows=None):
    fx.register(spark, sf_dir)
    control = spark.createDataFrame(fx.control_rows(spark, sf_dir), CONTROL_SCHEMA)
    entries = to_entries(control_scan(control, 1))
    return run_reconcile(spark, entries, SparkSources(spark), LakeTables(spark),
                         job_name=JOB_NAME, batch=BATCH, mode=mode, on_rows=on_rows)


def batch_plan(spark: SparkSession, sf_dir: str):
    fx.register(spark, sf_dir)
    control = spark.createDataFrame(fx.control_rows(spark, sf_dir), CONTROL_SCHEMA)
    entries = to_entries(control_scan(control, 1))
    return plan_reconcile(spark, entries, SparkSources(spark), LakeTables(spark))


@query("reconcile_batch", ORACLE_BATCH)
def reconcile_batch(spark, sf_dir):
    """REC-4..REC-7: control scan, dispatch, the counts of all tables, audit rows.

    Its tables share no relations, so their counts are concurrent jobs (``mode="auto"``).
    """
    return batch_result(spark, sf_dir, mode="auto").audit.select(*BATCH_COLS)


@query("reconcile_batch_joint", ORACLE_BATCH)
def reconcile_batch_joint(spark, sf_dir):
    """The same batch with all counts in one plan, returned lazily: the job runs when the caller collects."""
    return reconcile_frame(spark, batch_plan(spark, sf_dir), JOB_NAME, BATCH).select(*BATCH_COLS)


@query("audit_rows", f"SELECT *, TRUE AS HAS_INSERT_TIMESTAMP, STATUS = 'SUCCESS' AS HAS_ELAPSED, "
       f"STATUS = 'FAILED' AS NAMES_ITS_ERROR FROM ({ORACLE_BATCH}) b")
def audit_rows(spark, sf_dir):
    """SNK-1, REC-5: the batch's audit rows appended to an audit table as they are done, read back."""
    target = scratch_path(spark, "audit")
    batch_result(spark, sf_dir, on_rows=lambda rows: append_audit(rows, target))
    back = read_audit(spark, target)
    elapsed = "^[0-9]{2,}:[0-5][0-9]:[0-5][0-9]$"
    return back.select(
        *BATCH_COLS, F.col("INSERT_TIMESTAMP").isNotNull().alias("HAS_INSERT_TIMESTAMP"),
        F.coalesce(F.col("SRC_QUERY_EXEC_TIME").rlike(elapsed) & F.col("TARGET_QUERY_EXEC_TIME").rlike(elapsed),
                   F.lit(False)).alias("HAS_ELAPSED"),
        F.coalesce(F.col("ERROR_MESSAGE").contains(F.col("TABLE_NAME"))
                   & (F.char_length("ERROR_MESSAGE") <= 1000), F.lit(False)).alias("NAMES_ITS_ERROR"))


# --------------------------------------------------------------------------- ingestion

_MARK_2001 = dt.datetime(2001, 6, 1)
S_LINEITEM_INC = (f"SELECT * FROM {S_LINEITEM_LAKE} a WHERE l_shipdate <= TIMESTAMP '2001-06-01' "
                  f"UNION ALL SELECT * FROM lineitem WHERE l_shipdate > TIMESTAMP '2001-06-01'")
S_EVENTS_INC = f"SELECT * FROM {S_EVENTS_LAKE} a UNION ALL SELECT * FROM events WHERE event_id > {S_OFF}"
S_ORDERS_UPD = ("(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, "
                "o_orderdate, o_orderpriority FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-01')")
S_ORDERS_MERGED = (f"SELECT * FROM {S_ORDERS_UPD} u UNION ALL SELECT * FROM {S_ORDERS_LAKE} t "
                   f"WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {S_ORDERS_UPD} k)")
ORDERS_UPD_SQL = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, "
                  "o_orderdate, o_orderpriority FROM orders")


def _lake(spark) -> LakeLocation:
    return LakeLocation(spark, root=scratch_path(spark, "lake"))


def _with_year(df: DataFrame) -> DataFrame:
    return df.withColumn("o_year", F.year("o_orderdate"))


@query("load_full", "SELECT * FROM orders")
def q_load_full(spark, sf_dir):
    """ING-1: the lake table replaced by the whole extract."""
    lake = _lake(spark)
    orders = fx.read_table(spark, sf_dir, "orders")
    load_full(orders.where(F.col("o_orderkey") < 0), lake, "orders")  # an earlier, different state
    load_full(orders, lake, "orders")
    return lake.read("orders")


@query("load_incremental_ts", S_LINEITEM_INC)
def q_load_incremental_ts(spark, sf_dir):
    """ING-2 by time mark: rows after the mark appended to the lake copy."""
    lake = _lake(spark)
    li = fx.read_table(spark, sf_dir, "lineitem")
    load_full(fx.lineitem_lake(li).where(F.col("l_shipdate") <= ts_literal(_MARK_2001)), lake, "lineitem")
    load_incremental(li, lake, "lineitem", "l_shipdate", _MARK_2001)
    return lake.read("lineitem")


@query("load_incremental_offset", S_EVENTS_INC)
def q_load_incremental_offset(spark, sf_dir):
    """ING-2 by numeric mark."""
    lake = _lake(spark)
    ev = fx.read_table(spark, sf_dir, "events")
    load_full(fx.events_lake(ev), lake, "events")
    load_incremental(ev, lake, "events", "event_id", fx.events_offset_value(spark, sf_dir))
    return lake.read("events")


@query("load_merge", f"SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM ({S_ORDERS_MERGED}) m")
def q_load_merge(spark, sf_dir):
    """ING-3: upsert by key into a year-partitioned lake table.

    Only the years holding an updated order are rewritten.
    """
    fx.register(spark, sf_dir)
    lake = _lake(spark)
    load_full(_with_year(spark.table("orders_lake")), lake, "orders", ["o_year"])
    load_merge(_with_year(spark.sql(ORDERS_UPD_SQL)), lake, "orders", ["o_orderkey"],
               "o_orderdate", _MARK_2001, partition_by=["o_year"])
    return lake.read("orders")


# Partition values of every awkward kind: NULL, a space, a leading zero, a sign of the path, not ASCII.
S_EDGE_PART = ("CASE {0} % 5 WHEN 0 THEN NULL WHEN 1 THEN 'a b' WHEN 2 THEN '01' WHEN 3 THEN 'x=y%' ELSE 'é' END")


@query("load_merge_edges", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       {S_EDGE_PART.format('o_orderkey')} AS part
FROM {S_ORDERS_LAKE} t WHERE o_orderkey % 7 <> 0
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 3 AS o_totalprice,
       o_orderdate + INTERVAL 1 DAY AS o_orderdate, o_orderpriority, {S_EDGE_PART.format('(o_orderkey + 1)')} AS part
FROM orders WHERE o_orderkey % 7 = 0""")
def q_load_merge_edges(spark, sf_dir):
    """ING-3 at its edges: two versions of each updated key (the newer one wins), NULL and
    awkward partition values, keys that move to another partition, one partition that is
    emptied by that; merged twice, which must equal once."""
    orders = fx.read_table(spark, sf_dir, "orders")
    part = F.expr(S_EDGE_PART.format("o_orderkey"))
    lake = _lake(spark)
    emptied = (F.col("o_orderkey") % 35) == 14   # all of these are updated, and move
    load_full(fx.orders_lake(orders).withColumn("part", F.when(emptied, F.lit("moved away")).otherwise(part)),
              lake, "orders", ["part"])
    due = orders.where(F.col("o_orderkey") % 7 == 0)
    older = due.withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("part", part)
    newer = (due.withColumn("o_totalprice", F.col("o_totalprice") * 3)
             .withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
             .withColumn("part", F.expr(S_EDGE_PART.format("(o_orderkey + 1)"))))
    for _ in range(2):
        load_merge(older.unionByName(newer), lake, "orders", ["o_orderkey"], "o_orderdate")
    return lake.read("orders").select(*orders.columns, "part")


@query("overwrite_partitions", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN year(o_orderdate) = 1995 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS o_year
FROM orders""")
def q_overwrite_partitions(spark, sf_dir):
    """SNK-3: replace one year's partition; the other years stay as written."""
    lake = _lake(spark)
    orders = _with_year(fx.read_table(spark, sf_dir, "orders"))
    load_full(orders, lake, "orders", ["o_year"])
    repriced = orders.where(F.col("o_year") == 1995).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2)
    overwrite_partitions(repriced, lake, "orders", ["o_year"])
    return lake.read("orders")


def ingestion_control(spark: SparkSession, sf_dir: str) -> list[ControlEntry]:
    off = fx.events_offset_value(spark, sf_dir)
    return [
        ControlEntry(1, 1, "SELECT * FROM orders", "mssql", "orders", "Full Load", priority=1),
        ControlEntry(2, 1, "SELECT * FROM lineitem WHERE l_shipdate > {startdatetime}", "mssql", "lineitem",
                     "incremental", _MARK_2001, "l_shipdate", priority=2, base_query="SELECT * FROM lineitem"),
        ControlEntry(3, 1, "SELECT * FROM events WHERE event_id > {offset_value}", "mssql", "events",
                     "Incremental", dt.datetime(2024, 2, 9), "event_id", off, priority=3,
                     base_query="SELECT * FROM events"),
        ControlEntry(4, 1, ORDERS_UPD_SQL, "mssql", "orders_merged", "merge", _MARK_2001,
                     "o_orderdate", priority=4, merge_key="o_orderkey"),
        ControlEntry(5, 1, "SELECT * FROM orders", "mssql", "orders_snapshot", "Snapshot", priority=5),
    ]


RUN_PARTITIONS = {"orders": "o_orderpriority", "lineitem": "l_returnflag", "events": "event_type",
                  "orders_merged": "o_orderstatus"}


def _run_row(i, table, load, status, loaded, after) -> str:
    by = f"'{RUN_PARTITIONS[table]}'" if table in RUN_PARTITIONS else "CAST(NULL AS VARCHAR)"
    return (f"SELECT CAST({i} AS BIGINT) AS ID, '{table}' AS TABLE_NAME, '{load}' AS LOAD_TYPE, "
            f"'{status}' AS STATUS, CAST(({loaded}) AS BIGINT) AS ROWS_LOADED, "
            f"CAST(({after}) AS BIGINT) AS ROWS_IN_TABLE, {by} AS PARTITIONED_BY")


_C = "SELECT count(*) FROM ({}) x".format


@query("ingestion_run", "\nUNION ALL\n".join([
    _run_row(1, "orders", "Full Load", "SUCCESS", _C("SELECT * FROM orders"), _C("SELECT * FROM orders")),
    _run_row(2, "lineitem", "incremental", "SUCCESS",
             _C("SELECT * FROM lineitem WHERE l_shipdate > TIMESTAMP '2001-06-01'"), _C(S_LINEITEM_INC)),
    _run_row(3, "events", "Incremental", "SUCCESS",
             _C(f"SELECT * FROM events WHERE event_id > {S_OFF}"), _C(S_EVENTS_INC)),
    _run_row(4, "orders_merged", "merge", "SUCCESS", _C(f"SELECT * FROM {S_ORDERS_UPD} u"),
             _C(S_ORDERS_MERGED)),
    _run_row(5, "orders_snapshot", "Snapshot", "FAILED", "NULL", "NULL"),
]))
def q_ingestion_run(spark, sf_dir):
    """ING-4 + SNK-4: a control group loaded in priority order into partitioned tables; the
    run audit appended and read back, joined with the row count and the partition column of
    every lake table after the run."""
    fx.register(spark, sf_dir)
    lake = _lake(spark)
    by = RUN_PARTITIONS
    li = fx.read_table(spark, sf_dir, "lineitem")
    load_full(spark.table("orders_lake"), lake, "orders", [by["orders"]])
    load_full(fx.lineitem_lake(li).where(F.col("l_shipdate") <= ts_literal(_MARK_2001)), lake, "lineitem",
              [by["lineitem"]])
    load_full(fx.events_lake(fx.read_table(spark, sf_dir, "events")), lake, "events", [by["events"]])
    load_full(spark.table("orders_lake"), lake, "orders_merged", [by["orders_merged"]])
    run = run_ingestion(spark, ingestion_control(spark, sf_dir), SparkSources(spark), lake,
                        job_name="LAKE_INGESTION", batch=BATCH)
    target = scratch_path(spark, "run-audit")
    append_rows(run.audit, target)
    sizes = reduce(lambda a, b: a.unionByName(b), [
        lake.read(t).agg(F.count(F.lit(1)).alias("ROWS_IN_TABLE")).select(
            F.lit(t).alias("TABLE_NAME"), "ROWS_IN_TABLE", F.lit(",".join(lake.partitions(t))).alias("PARTITIONED_BY"))
        for t in by])
    return (read_audit(spark, target).join(sizes, "TABLE_NAME", "left")
            .select("ID", "TABLE_NAME", "LOAD_TYPE", "STATUS", "ROWS_LOADED", "ROWS_IN_TABLE", "PARTITIONED_BY"))


# --------------------------------------------------------------------------- maintenance

G9_TARGET = 2000  # about a quarter of the documents are of a good size, and left alone


@query("compaction_plan", f"""
SELECT doc_id, source, n_chars,
       CAST(FLOOR(COALESCE(SUM(n_chars) OVER (PARTITION BY source ORDER BY doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / {G9_TARGET}) AS BIGINT) AS bin
FROM documents WHERE n_chars < {G9_TARGET * 0.75} OR n_chars > {G9_TARGET * 1.8}""")
def q_compaction_plan(spark, sf_dir):
    """MNT-1 plan: documents stand in for a file inventory (file = doc_id,
    partition = source, bytes = n_chars); candidates packed into 2 000-byte bins."""
    inv = fx.read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    plan = compaction_plan(inv, partition_cols=["source"], order_col="doc_id",
                           size_col="n_chars", target_bytes=G9_TARGET)
    return plan.select("doc_id", "source", "n_chars", F.col("bin").cast("long").alias("bin"))


def small_file_table(spark: SparkSession, df: DataFrame, name: str, files: int,
                     partition_by: list[str] | None = None) -> str:
    path = scratch_path(spark, name)
    w = df.repartition(files).write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


# A table with every kind of partition value, and a column that its older files lack.
S_GROWN = (f"SELECT l.*, CASE WHEN l_linenumber > 3 THEN l_quantity * 2 END AS added, "
           f"CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN '01' WHEN 2 THEN '1' ELSE 'a b' END AS m FROM lineitem l")


@query("compaction_rewrite", f"SELECT *, 0 AS files_again FROM ({S_GROWN}) t")
def q_compaction_rewrite(spark, sf_dir):
    """MNT-1 carried out on a copy of lineitem in many small files: partitions ``01``, ``1``,
    ``a b`` and NULL, a column added after half of the files were written.  The rows stay
    as they are, and sweeps converge: after a few (tiny files shrink when their footers are
    merged) one rewrites no file (``files_again``)."""
    li = fx.read_table(unsorted_writes(spark), sf_dir, "lineitem").withColumn("m", F.expr(
        "CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN '01' WHEN 2 THEN '1' ELSE 'a b' END"))
    path = scratch_path(spark, "small-lineitem")
    li.where("l_linenumber <= 3").repartition(8).write.partitionBy("m").parquet(path)
    (li.where("l_linenumber > 3").withColumn("added", F.col("l_quantity") * 2).repartition(8)
     .write.mode("append").partitionBy("m").parquet(path))
    target = int(file_inventory(spark, path).agg(F.sum("size")).first()[0] // 6)

    def sweep_once():
        plan = compaction_plan(file_inventory(spark, path), partition_cols=["folder"], order_col="modified",
                               tie_cols=["path"], target_bytes=target)
        return rewrite_bins(spark, path, plan, ["m"], dry_run=False, target_bytes=target)

    again = next((n for n in (sweep_once().files_removed for _ in range(4)) if not n), -1)
    columns = [*li.drop("m").columns, "added", "m"]
    whole = spark.read.schema(compaction_schema(spark, path, ["m"])).parquet(path)
    return whole.select(*columns, F.lit(again).alias("files_again"))


@query("snapshot_expiry", """
SELECT event_id, user_id, ts FROM (
  SELECT event_id, user_id, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk
  FROM events) r
WHERE rk > 1 AND ts < TIMESTAMP '2024-01-26'""")
def q_snapshot_expiry(spark, sf_dir):
    """MNT-2: events stand in for snapshots (table = user_id, commit time = ts);
    expire those before 2024-01-26 except each table's newest."""
    ev = fx.read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return expired_snapshots(ev, table_cols=["user_id"], time_col="ts", id_col="event_id",
                             older_than=dt.datetime(2024, 1, 26), retain_last=1) \
        .select("event_id", "user_id", "ts")


@query("orphan_files", """
SELECT doc_id, source, n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_orphan_files(spark, sf_dir):
    """MNT-3: documents stand in for the file listing, labels for the files
    metadata refers to; unreferenced files are orphans."""
    listing = fx.read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    referenced = fx.read_table(spark, sf_dir, "labels")
    return orphan_files(listing, referenced, on="doc_id", modified_col=None)


def _sweep_rows(table: str, count_sql: str) -> str:
    statuses = [("rewrite_data_files", "SUCCESS"), ("rewrite_manifests", "SKIPPED"),
                ("expire_snapshots", "SKIPPED"), ("remove_orphan_files", "SUCCESS")]
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS TABLE_NAME, '{step}' AS STEP, "
        f"'{st}' AS STATUS, CAST(({count_sql}) AS BIGINT) AS ROWS_AFTER" for step, st in statuses)


@query("maintenance_sweep", "\nUNION ALL\n".join([
    _sweep_rows("lineitem", "SELECT count(*) FROM lineitem"),
    _sweep_rows("orders", "SELECT count(*) FROM orders"),
    "SELECT 'd1_orders' AS TABLE_NAME, CAST(NULL AS VARCHAR) AS STEP, "
    f"'EXCLUDED' AS STATUS, CAST((SELECT count(*) FROM orders) AS BIGINT) AS ROWS_AFTER"]))
def q_maintenance_sweep(spark, sf_dir):
    """MNT-4: a database of small-file Parquet tables swept; names holding the
    exclusion token are skipped; row counts after compaction are unchanged."""
    db = "lakeops_maintenance_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'warehouse')}'")
    li = fx.read_table(unsorted_writes(spark), sf_dir, "lineitem")
    orders = fx.read_table(spark, sf_dir, "orders")
    li.repartition(16).write.partitionBy("l_returnflag").saveAsTable(f"{db}.lineitem")
    orders.repartition(16).write.saveAsTable(f"{db}.orders")
    orders.repartition(4).write.saveAsTable(f"{db}.d1_orders")
    target = 4 * int(file_inventory(spark, f"{scratch_root_of(spark, db)}/orders")
                     .agg(F.sum("size")).first()[0] // 16)
    try:
        report = sweep(spark, [db], ParquetMaintenance(spark, target_bytes=target, dry_run=False))
        counts = _table_counts(spark, db, ("lineitem", "orders", "d1_orders"))
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
    return (report.join(counts, "TABLE_NAME")
            .select("TABLE_NAME", "STEP", "STATUS", F.col("ROWS").alias("ROWS_AFTER")))


def _table_counts(spark: SparkSession, db: str, names) -> DataFrame:
    """Rows of each table, counted in one job now: the database may be dropped afterwards."""
    counts = reduce(lambda a, b: a.unionByName(b), [
        spark.table(f"{db}.{t}").agg(F.count(F.lit(1)).alias("ROWS")).select(F.lit(t).alias("TABLE_NAME"), "ROWS")
        for t in names])
    return spark.createDataFrame(counts.collect(), "TABLE_NAME string, ROWS bigint")


def scratch_root_of(spark: SparkSession, database: str) -> str:
    return spark.sql(f"DESCRIBE DATABASE {database}").where(
        F.col("info_name") == "Location").first()["info_value"]


# --------------------------------------------------------------------------- file drops

CUSTOMER_DDL = ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING")


@query("file_drop_ingest", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def q_file_drop_ingest(spark, sf_dir):
    """SRC-9: customer dropped once as CSV and once as JSON, read back with the
    declared schema and loaded into one lake table."""
    customer = fx.read_table(spark, sf_dir, "customer")
    drops = scratch_path(spark, "drops")
    write_drop(customer, f"{drops}/csv", "csv")
    write_drop(customer, f"{drops}/json", "json")
    lake = _lake(spark)
    both = read_dropped(spark, f"{drops}/csv", "csv", CUSTOMER_DDL).unionByName(
        read_dropped(spark, f"{drops}/json", "json", CUSTOMER_DDL))
    load_full(both, lake, "customer")
    return lake.read("customer")


@query("file_drop_stream", "SELECT * FROM customer")
def q_file_drop_stream(spark, sf_dir):
    """SRC-9 incrementally: customer arrives as two CSV drops (nations below 13,
    then the rest); a run after each drop, and a third with nothing new, load
    every row exactly once."""
    customer = fx.read_table(spark, sf_dir, "customer")
    drops, target = scratch_path(spark, "drops"), scratch_path(spark, "lake-customer")
    ckpt = scratch_path(spark, "ckpt-customer")
    early = F.coalesce(F.col("c_nationkey") < 13, F.lit(False))
    write_drop(customer.where(early), drops, "csv")
    ingest_drops(spark, drops, "csv", CUSTOMER_DDL, target, ckpt)
    write_drop(customer.where(~early), drops, "csv")
    ingest_drops(spark, drops, "csv", CUSTOMER_DDL, target, ckpt)
    ingest_drops(spark, drops, "csv", CUSTOMER_DDL, target, ckpt)
    return spark.read.parquet(target)


# --------------------------------------------------------------------------- many marks
MANY_MARKS = [dt.datetime(1992 + i // 2, 1 + 6 * (i % 2), 1) for i in range(12)]


def many_marks_entries() -> list[ControlEntry]:
    return [ControlEntry(100 + i, 1, "SELECT * FROM lineitem", "oracle", "lineitem_lake",
                         "incremental", m, "l_shipdate", priority=i)
            for i, m in enumerate(MANY_MARKS)]


def _many_marks_sql() -> str:
    parts = []
    for i, m in enumerate(MANY_MARKS):
        d = m.strftime("%Y-%m-%d")
        src = f"SELECT count(*) FROM lineitem WHERE {s_win('l_shipdate', d)}"
        lake = f"SELECT count(*) FROM {S_LINEITEM_LAKE} t WHERE {s_win('l_shipdate', d, False)}"
        parts.append(f"SELECT CAST({100 + i} AS BIGINT) AS ID, TIMESTAMP '{d}' AS STARTDATETIME, "
                     f"({src}) AS SOURCE_COUNT, ({lake}) AS DATALAKE_COUNT, "
                     f"({src}) - ({lake}) AS COUNT_DIFF")
    return "\nUNION ALL\n".join(parts)


@query("reconcile_many_marks", _many_marks_sql())
def reconcile_many_marks(spark, sf_dir):
    """REC-7 with twelve control rows on one source/lake pair (a trailing
    window every half year): the 24 counts take one scan of each relation."""
    fx.register(spark, sf_dir)
    plan = plan_reconcile(spark, many_marks_entries(), SparkSources(spark), LakeTables(spark))
    return reconcile_frame(spark, plan, JOB_NAME, BATCH).select(
        "ID", "STARTDATETIME", "SOURCE_COUNT", "DATALAKE_COUNT", "COUNT_DIFF")


N_MARKS = 1200


def thousand_marks_entries() -> list[ControlEntry]:
    """A mark every two days; every third one is an offset of the events table instead."""
    at = [dt.datetime(1992, 1, 1) + dt.timedelta(days=2 * i) for i in range(N_MARKS)]
    return [ControlEntry(1000 + i, 1, "SELECT * FROM events", "mssql", "events_lake", "merge", None, "event_id", 7 * i, i)
            if i % 3 == 0 else
            ControlEntry(1000 + i, 1, "SELECT * FROM lineitem", "oracle", "lineitem_lake", "incremental", m, "l_shipdate",
                         None, i)
            for i, m in enumerate(at)]


@query("reconcile_thousand_marks", f"""
WITH marks AS (SELECT 1000 + i AS ID, i, TIMESTAMP '1992-01-01' + to_days(CAST(2 * i AS INTEGER)) AS m FROM range({N_MARKS}) r(i)),
src AS (SELECT l_shipdate AS d, count(*) AS n FROM lineitem GROUP BY 1),
lake AS (SELECT l_shipdate AS d, count(*) AS n FROM {S_LINEITEM_LAKE} t GROUP BY 1),
counted AS (
  SELECT ID, (SELECT coalesce(sum(n), 0) FROM src WHERE d > m - INTERVAL 30 DAY AND d <= m) AS s,
         (SELECT coalesce(sum(n), 0) FROM lake WHERE d > m - INTERVAL 30 DAY) AS l
  FROM marks WHERE i % 3 <> 0
  UNION ALL
  SELECT ID, (SELECT count(*) FROM events WHERE event_id <= 7 * i) AS s, (SELECT count(*) FROM {S_EVENTS_LAKE} e) AS l
  FROM marks WHERE i % 3 = 0)
SELECT CAST(ID AS BIGINT) AS ID, CAST(s AS BIGINT) AS SOURCE_COUNT, CAST(l AS BIGINT) AS DATALAKE_COUNT,
       CAST(s - l AS BIGINT) AS COUNT_DIFF FROM counted""")
def reconcile_thousand_marks(spark, sf_dir):
    """REC-7 with FLT-2, FLT-4 and FLT-5 at 1,200 marks: one scan of each relation, in which a row finds
    its place among the sorted marks by binary search."""
    fx.register(spark, sf_dir)
    plan = plan_reconcile(spark, thousand_marks_entries(), SparkSources(spark), LakeTables(spark))
    return reconcile_frame(spark, plan, JOB_NAME, BATCH).select("ID", "SOURCE_COUNT", "DATALAKE_COUNT", "COUNT_DIFF")


# --------------------------------------------------------------------------- control rows as text
@query("control_order", "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS BIGINT) AS id, CAST({place} AS BIGINT) AS place, '1733011200_1' AS batch, "
    f"lpad(CAST((n // 3600) AS VARCHAR), 2, '0') || ' Hour ' || lpad(CAST((n // 60 % 60) AS VARCHAR), 2, '0') || ' Minutes ' || "
    f"lpad(CAST((n % 60) AS VARCHAR), 2, '0') || ' Seconds' AS elapsed FROM (SELECT count(*) AS n FROM orders) c"
    for place, i in enumerate((2, 3, 1, 4, 5, 6, 7))))
def q_control_order(spark, sf_dir):
    """SRT-1, SCL-8, SCL-9: the place of every control row in its group's run (by priority, then id), the batch id
    of a given instant, and a number of seconds (as many as there are orders) in words."""
    control = spark.createDataFrame(fx.control_rows(spark, sf_dir), CONTROL_SCHEMA)
    entries = to_entries(control_scan(control, 1))
    batch = batch_number(1, dt.datetime(2024, 12, 1, tzinfo=dt.timezone.utc))
    elapsed = hms_words(fx.read_table(spark, sf_dir, "orders").count())
    return spark.createDataFrame([(e.id, place, batch, elapsed) for place, e in enumerate(entries)],
                                 "id bigint, place bigint, batch string, elapsed string")


# --------------------------------------------------------------------------- listing
LISTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("table_listing", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS TABLE_NAME, CAST(count(*) AS BIGINT) AS ROWS FROM {t}" for t in LISTED))
def q_table_listing(spark, sf_dir):
    """SRC-6 + FLT-7: the given tables registered in a database (as external
    tables over their files, plus one name holding the exclusion token),
    listed, filtered, and counted in one job."""
    db = "lakeops_listing_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'listing')}'")
    try:
        for t in LISTED + ("d1_orders",):
            src = "orders" if t == "d1_orders" else t
            spark.catalog.createTable(f"{db}.{t}", path=f"{sf_dir.rstrip('/')}/{src}.parquet",
                                      source="parquet")
        names = spark.createDataFrame([(n,) for n in list_tables(spark, db)], "name string")
        return _table_counts(spark, db, [r.name for r in without_excluded(names).collect()])
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
