"""The control table: which tables a job group handles, and how.

Columns: ``id, groupid, sql_query, source, schemaname, tablename, loadtype,
startdatetime, data_validation_column, offset_value, active,
data_validation_required, priority`` and, optionally, ``merge_key`` and
``base_query`` (the extract without its incremental predicate, for
reconciliation).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTROL_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("groupid", T.LongType()),
    T.StructField("sql_query", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("schemaname", T.StringType()),
    T.StructField("tablename", T.StringType()),
    T.StructField("loadtype", T.StringType()),
    T.StructField("startdatetime", T.TimestampNTZType()),
    T.StructField("data_validation_column", T.StringType()),
    T.StructField("offset_value", T.LongType()),
    T.StructField("active", T.IntegerType()),
    T.StructField("data_validation_required", T.IntegerType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("merge_key", T.StringType()),
])

_SELECTED = ["id", "groupid", "sql_query", "source", "schemaname", "tablename",
             "loadtype", "startdatetime", "data_validation_column", "offset_value",
             "priority", "merge_key", "base_query"]
OPTIONAL = ("merge_key", "base_query")


class LoadMode(str, Enum):
    FULL = "full"        # whole source vs whole lake table
    OFFSET = "offset"    # numeric high-water mark
    WINDOW = "window"    # time high-water mark, trailing window


@dataclass(frozen=True)
class ControlEntry:
    id: int
    groupid: int
    sql_query: str | None
    source: str | None
    tablename: str
    loadtype: str
    startdatetime: dt.datetime | None = None
    data_validation_column: str | None = None
    offset_value: int | None = None
    priority: int | None = None
    merge_key: str | None = None
    schemaname: str | None = None
    base_query: str | None = None

    @property
    def mode(self) -> LoadMode | None:
        """Load-type dispatch (REC-4).

        ``Full Load`` is matched exactly; ``merge`` and ``incremental`` in any
        case.  A non-null offset selects offset mode over the time mark
        (FLT-8).  Anything else has no mode: the row is skipped.
        """
        if self.loadtype == "Full Load":
            return LoadMode.FULL
        if self.loadtype is not None and self.loadtype.lower() in ("merge", "incremental"):
            return LoadMode.OFFSET if self.offset_value is not None else LoadMode.WINDOW
        return None

    @property
    def dialect(self) -> str:
        """``oracle`` (exact, lower case) or ``generic`` (SRC-3)."""
        return "oracle" if self.source == "oracle" else "generic"


def _filtered(control: DataFrame, group_id: int, validation: bool) -> DataFrame:
    cond = (F.col("groupid") == F.lit(group_id)) & (F.col("active") == 1)
    if validation:
        cond = cond & (F.col("data_validation_required") == 1)
    for c in OPTIONAL:
        if c not in control.columns:
            control = control.withColumn(c, F.lit(None).cast("string"))
    return (control.where(cond)
            .select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "startdatetime"
                      else F.col(c) for c in _SELECTED])
            .orderBy(F.col("priority").asc_nulls_last(), F.col("id").asc()))


def control_scan(control: DataFrame, group_id: int) -> DataFrame:
    """Rows to validate: group, active, validation required; by priority (SRC-5)."""
    return _filtered(control, group_id, validation=True)


def ingestion_scan(control: DataFrame, group_id: int) -> DataFrame:
    """Rows to load: group and active; by priority."""
    return _filtered(control, group_id, validation=False)


def to_entries(scanned: DataFrame) -> list[ControlEntry]:
    """Collect the control rows of one group.

    This is configuration (one row per table of the group), the only data
    this package brings to the driver besides one count per table.
    """
    out = []
    for r in scanned.collect():
        d = r.asDict()
        out.append(ControlEntry(
            id=d["id"], groupid=d["groupid"], sql_query=d["sql_query"], source=d["source"],
            tablename=d["tablename"], loadtype=d["loadtype"], startdatetime=d["startdatetime"],
            data_validation_column=d["data_validation_column"],
            offset_value=d["offset_value"], priority=d["priority"],
            merge_key=d.get("merge_key"), schemaname=d.get("schemaname"),
            base_query=d.get("base_query")))
    return out
