"""Audit appends (SNK-1, SNK-4, PRJ-1).

Rows get ``INSERT_TIMESTAMP`` (the statement time) and are appended by
column name, so a reordered frame cannot shift values into wrong columns.
A target is either a catalog table name or a storage path (Parquet).
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.joins import null_safe_join
from lakeops.operators.publish import Files


def with_insert_timestamp(rows: DataFrame, after: str = "START_OFFSET",
                          name: str = "INSERT_TIMESTAMP") -> DataFrame:
    """Insert ``current_timestamp()`` right after column ``after`` (PRJ-1)."""
    cols = []
    for c in rows.columns:
        cols.append(F.col(c))
        if c == after:
            cols.append(F.current_timestamp().alias(name))
    if after not in rows.columns:
        cols.append(F.current_timestamp().alias(name))
    return rows.select(*cols)


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


# Writers that append to one table at a time share its folder for temporary files.
_one_append = threading.RLock()


def append_rows(rows: DataFrame, target: str) -> None:
    """Append by name to a table or a Parquet path; tables loaded side by side may do so at once."""
    spark = rows.sparkSession
    if _is_path(target):
        # Files written beside the folder and moved in: writers do not meet in its temporary folder.
        files, stage = Files(spark), f"{target.rstrip('/').rpartition('/')[0]}/_append-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(stage)
        for name, _ in list(files.data_files(stage)):
            files.rename(f"{stage}/{name}", f"{target.rstrip('/')}/{name}")
        files.delete(stage)
        return
    with _one_append:
        _append_to_table(rows, target)


def _append_to_table(rows: DataFrame, target: str) -> None:
    spark = rows.sparkSession
    if spark.catalog.tableExists(target):
        existing = spark.table(target).columns
        missing = [c for c in existing if c not in rows.columns]
        if missing:
            raise ValueError(f"audit rows lack columns {missing} of {target}")
        rows.select(*existing).write.insertInto(target)
    else:
        rows.write.saveAsTable(target)


def exists(spark: SparkSession, target: str) -> bool:
    return Files(spark).exists(target) if _is_path(target) else spark.catalog.tableExists(target)


def append_once(rows: DataFrame, target: str, keys: list[str], within: str = "BATCH_NUMBER") -> None:
    """Append the rows whose keys the target does not hold yet.

    Only the target's rows of the same ``within`` values (a run's batch) are looked at, so the cost
    does not grow with the audit's age where it is pruned by that column.  Keys are compared
    null-safe; ``rows`` are few (one per table of a run) and are the broadcast side.
    """
    spark = rows.sparkSession
    if exists(spark, target):
        # The keys that are there, of these batches: never more than the audit rows of a run.
        batches = [r[0] for r in rows.select(within).distinct().collect()]
        there = read_audit(spark, target)
        mine = there.where(F.col(within).isin([b for b in batches if b is not None])
                           | (F.col(within).isNull() if None in batches else F.lit(False)))
        rows = null_safe_join(rows, mine.select(*keys).distinct(), keys, "left_anti")
        left = rows.collect()
        if not left:
            return
        rows = spark.createDataFrame(left, rows.schema)
    append_rows(rows, target)


def append_audit(rows: DataFrame, target: str) -> None:
    """Stamp and append validation audit rows (SNK-1); a batch that is told twice is there once.

    A row of a run is told by its batch, control id and table.
    """
    keys = [c for c in ("BATCH_NUMBER", "ID", "TABLE_NAME") if c in rows.columns]
    stamped = with_insert_timestamp(rows)
    if len(keys) == 3:
        append_once(stamped, target, keys)
    else:
        append_rows(stamped, target)


def read_audit(spark, target: str) -> DataFrame:
    return spark.read.parquet(target) if _is_path(target) else spark.table(target)
