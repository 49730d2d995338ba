"""Which loads are known to have happened (ING-2, ING-4, SNK-4).

A control row's high-water mark is saved after its run, apart from the rows: a driver lost
in between leaves rows in the lake that the next run would append again.  The ledger
closes that gap.  Before a load it gets an *intent* (batch, table, old mark); once the
rows are in place, a *commit* (rows, new mark), told by the publication itself and so told
even if the driver dies between the two.  A load then starts not from the control row's
mark but from where the commits that follow it end.

The ledger is an append-only Parquet table with two rows per load.  A commit is keyed by its
intent, so one that is told twice counts once.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.audit import append_once, exists, read_audit
from lakeops.operators.control import ControlEntry

LEDGER_SCHEMA = T.StructType([
    T.StructField("LOAD_ID", T.StringType()),
    T.StructField("STATE", T.StringType()),
    T.StructField("BATCH_NUMBER", T.StringType()),
    T.StructField("ID", T.LongType()),
    T.StructField("TABLE_NAME", T.StringType()),
    T.StructField("LOAD_TYPE", T.StringType()),
    T.StructField("OLD_MARK", T.StringType()),
    T.StructField("NEW_MARK", T.StringType()),
    T.StructField("ROWS_LOADED", T.LongType()),
])
INTENT, COMMIT = "INTENT", "COMMIT"


def mark_text(v) -> str | None:
    if v is None:
        return None
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ", timespec="microseconds")
    return str(v)


def _mark_value(text: str) -> int | dt.datetime:
    try:
        return int(text)
    except ValueError:
        return dt.datetime.fromisoformat(text)


class LoadLedger:
    """The ledger at ``target``, a catalog table or a Parquet folder."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target

    def read(self) -> DataFrame:
        if not exists(self.spark, self.target):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return read_audit(self.spark, self.target)

    def _told(self, **row) -> None:
        df = self.spark.createDataFrame([tuple(row.get(f.name) for f in LEDGER_SCHEMA)], LEDGER_SCHEMA)
        append_once(df, self.target, ["LOAD_ID", "STATE"], within="BATCH_NUMBER")

    def intend(self, entry: ControlEntry, batch: str, load_id: str | None = None) -> dict:
        """Note that a load is about to happen; returns what its publication has to remember.

        A ``load_id`` of the caller's names a load that may be asked for again.
        """
        mark = entry.offset_value if entry.offset_value is not None else entry.startdatetime
        note = {"LOAD_ID": load_id or uuid.uuid4().hex, "BATCH_NUMBER": batch, "ID": entry.id, "TABLE_NAME": entry.tablename,
                "LOAD_TYPE": entry.loadtype, "OLD_MARK": mark_text(mark)}
        self._told(STATE=INTENT, **note)
        return note

    def commit(self, note: dict) -> None:
        """Note that a load's rows are in place."""
        self._told(STATE=COMMIT, **note)

    def has_committed(self, load_id: str) -> bool:
        return bool(self.read().where((F.col("STATE") == COMMIT) & (F.col("LOAD_ID") == load_id)).limit(1).count())

    def committed(self, entry: ControlEntry) -> dict[str | None, str]:
        """Old mark to the furthest new mark of this entry's committed incremental loads (one row per load)."""
        rows = (self.read().where((F.col("STATE") == COMMIT) & (F.col("ID") == entry.id)
                                  & (F.col("TABLE_NAME") == entry.tablename)
                                  & F.lower("LOAD_TYPE").isin("incremental", "merge") & F.col("NEW_MARK").isNotNull())
                .select("OLD_MARK", "NEW_MARK").distinct().collect())
        ahead: dict[str | None, str] = {}
        for r in rows:
            best = ahead.get(r["OLD_MARK"])
            if best is None or _mark_value(r["NEW_MARK"]) > _mark_value(best):
                ahead[r["OLD_MARK"]] = r["NEW_MARK"]
        return ahead

    def resumed(self, entry: ControlEntry, target_exists: bool) -> ControlEntry:
        """The entry with its mark moved to where the commits from that mark on end.

        A target that is not there (any more) has nothing committed.  Marks set back by
        hand are followed up again: to load rows anew, :meth:`forget` the table first.
        """
        if not target_exists or (entry.loadtype or "").lower() not in ("incremental", "merge"):
            return entry
        ahead = self.committed(entry)
        start = mark = mark_text(entry.offset_value if entry.offset_value is not None else entry.startdatetime)
        while mark in ahead and ahead[mark] != mark:
            mark = ahead.pop(mark)
        if mark == start:
            return entry
        value = _mark_value(mark)
        if isinstance(value, dt.datetime):
            return replace(entry, startdatetime=value)
        return replace(entry, offset_value=value)

    def forget(self, table: str) -> None:
        """Drop a table's rows from the ledger, for a reload from an older mark."""
        from lakeops.jobs import save_control
        save_control(self.read().where(F.col("TABLE_NAME") != table), self.target)
