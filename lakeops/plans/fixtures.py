"""Test relations derived from the given tables.

Each lake copy below is the source table minus a deterministic slice of rows,
standing in for rows an ingestion run lost; reconciliation has to find that
difference.  The slices are part of the fixture definition, not a way to
read less: every query built on them scans the whole source table.  The
same definitions are written in SQL in :mod:`lakeops.plans.catalogue` so the
DuckDB oracle computes the same relations.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_lake(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderkey") % 50 != 7)


def lineitem_lake(lineitem: DataFrame) -> DataFrame:
    return lineitem.where((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 101 != 3)


def events_offset(events: DataFrame):
    """The numeric mark ``floor(0.75 * count(events))`` as a scalar subquery."""
    return events.select(F.floor(F.count(F.lit(1)) * 0.75).cast("long")).scalar()


def events_lake(events: DataFrame) -> DataFrame:
    return events.where((F.col("event_id") <= events_offset(events))
                        & (F.col("event_id") % 40 != 3))


def events_src(events: DataFrame) -> DataFrame:
    """A source whose time columns are text: NULL, unparsable, or a timestamp."""
    r = F.col("event_id") % 3
    modified = (F.when(r == 0, F.lit(None).cast("string"))
                .when(r == 1, F.lit("bad"))
                .otherwise((F.col("ts") + F.make_dt_interval(F.lit(1))).cast("string")))
    return events.select("event_id", modified.alias("modified_on"),
                         F.col("ts").cast("string").alias("created_on"))


def events_src_lake(src: DataFrame) -> DataFrame:
    """The typed lake copy of :func:`events_src`: text converted, unparsable to NULL."""
    return src.where(F.col("event_id") % 40 != 3).select(
        "event_id",
        F.col("modified_on").try_cast("timestamp_ntz").alias("modified_on"),
        F.col("created_on").try_cast("timestamp_ntz").alias("created_on"))


# Session setting that names the folder whose views are registered.
_REGISTERED = "lakeops.fixtures"


def register(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Register base tables and derived lake copies as temporary views.

    Done once per session and data folder; later calls reuse the views while
    they are still registered.
    """
    names = ("orders", "lineitem", "events", "customer", "documents", "labels", "orders_lake", "lineitem_lake",
             "events_lake", "events_src", "events_src_lake")
    if spark.conf.get(_REGISTERED, "") == sf_dir and all(spark.catalog.tableExists(n) for n in names):
        return {n: spark.table(n) for n in names}
    views: dict[str, DataFrame] = {}
    for name in ("orders", "lineitem", "events", "customer", "documents", "labels"):
        views[name] = read_table(spark, sf_dir, name)
    views["orders_lake"] = orders_lake(views["orders"])
    views["lineitem_lake"] = lineitem_lake(views["lineitem"])
    views["events_lake"] = events_lake(views["events"])
    views["events_src"] = events_src(views["events"])
    views["events_src_lake"] = events_src_lake(views["events_src"])
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    spark.conf.set(_REGISTERED, sf_dir)
    return views


def events_offset_value(spark: SparkSession, sf_dir: str) -> int:
    """The same mark as a literal, as a control table would store it."""
    return read_table(spark, sf_dir, "events").count() * 3 // 4


def control_rows(spark: SparkSession, sf_dir: str) -> list[tuple]:
    """Control rows of the batch fixture: groups, flags, priorities and load types.

    Group 1 holds the run; the other rows test filtering and dispatch.
    """
    off = events_offset_value(spark, sf_dir)
    d1998 = dt.datetime(1998, 12, 1)
    d2024 = dt.datetime(2024, 2, 9)
    q = "SELECT * FROM {}".format
    # id, group, sql_query, source, schema, table, loadtype, start, column, offset,
    # active, required, priority, merge_key
    return [
        (1, 1, q("orders"), "oracle", "s", "orders_lake", "Full Load", d1998, None, None, 1, 1, 3, "o_orderkey"),
        (2, 1, q("lineitem"), "oracle", "s", "lineitem_lake", "incremental", d1998, "l_shipdate", None, 1, 1, 1, None),
        (3, 1, q("events"), "mssql", "s", "events_lake", "Merge", d2024, "event_id", off, 1, 1, 2, "event_id"),
        (4, 1, q("events_src"), "mssql", "s", "events_src_lake", "merge", d2024,
         "modified_on, created_on", None, 1, 1, 4, "event_id"),
        (5, 1, q("orders"), "mssql", "s", "no_such_table", "Full Load", d2024, None, None, 1, 1, 5, None),
        (6, 1, q("orders"), "mssql", "s", "orders_lake", "Snapshot", d2024, None, None, 1, 1, 6, None),
        (7, 1, q("orders"), "mssql", "s", "orders_lake", "full load", d2024, None, None, 1, 1, 7, None),
        (8, 1, q("orders"), "mssql", "s", "orders_lake", "Full Load", d2024, None, None, 0, 1, 8, None),
        (9, 1, q("orders"), "mssql", "s", "orders_lake", "Full Load", d2024, None, None, 1, 0, 9, None),
        (10, 2, q("orders"), "mssql", "s", "orders_lake", "Full Load", d2024, None, None, 1, 1, 1, None),
    ]


def control_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeops.operators.control import CONTROL_SCHEMA
    return spark.createDataFrame(control_rows(spark, sf_dir), CONTROL_SCHEMA)
