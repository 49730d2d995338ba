"""Incremental file-drop ingestion with Structured Streaming (SRC-9 + ING-2).

The file source remembers, in the checkpoint, which files it has consumed;
``trigger(availableNow=True)`` processes everything that arrived since the
last run and stops.  Run it on a schedule: each file is loaded exactly once
even across failures and restarts, because the sink commits output and
source offsets together.  The checkpoint must be on shared storage and
stable across runs (not a per-run scratch folder).

:func:`load_drops` puts the new files into a lake table, appended or merged by key: each
micro-batch is one load, known to the ledger by the checkpoint and the batch number.  A
batch that the stream replays (its load was done, the checkpoint not yet written) is
recognised and left out.  :class:`DropLoads` does that for control rows.
"""

from __future__ import annotations

import dataclasses
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from lakeops.functions.predicates import split_columns
from lakeops.operators.control import ControlEntry
from lakeops.operators.ingest import LakeLocation, LoadResult, load_incremental, load_merge
from lakeops.operators.ledger import LoadLedger
from lakeops.sources.files import FileDropSources, reader_options


def load_drops(spark: SparkSession, drop_path: str, fmt: str, schema: T.StructType | str, lake: LakeLocation,
               table: str, checkpoint: str, ledger: LoadLedger, *, keys: list[str] | None = None,
               order_by: list[str] | None = None, partition_by: list[str] | None = None, batch: str = "",
               entry_id: int | None = None, options: dict | None = None,
               max_files_per_trigger: int | None = None) -> int:
    """Load the files that arrived since the last run into ``table``; returns the rows loaded.

    With ``keys``, rows are merged by them (of several versions in a batch the one with the largest
    ``order_by``); else they are appended.
    """
    opts = reader_options(fmt, options)
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    stream = spark.readStream.schema(schema).format(fmt).options(**opts).load(drop_path)
    loaded = []

    def load(rows: DataFrame, number: int) -> None:
        # A micro-batch belongs to a session of its own.
        here = dataclasses.replace(lake, spark=rows.sparkSession)
        here.finish(table, ledger.commit)
        load_id = f"{checkpoint}#{number}"
        if ledger.has_committed(load_id):
            return  # replayed
        note = ledger.intend(ControlEntry(entry_id, None, None, None, table, "merge" if keys else "incremental"), batch, load_id)
        if keys:
            done = load_merge(rows, here, table, keys, None, None, order_by, partition_by, note=note, done=ledger.commit)
        else:
            done = load_incremental(rows, here, table, None, None, partition_by, note=note, done=ledger.commit)
        loaded.append(done.rows)

    query = (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if loaded:  # files came by way of another session
        if lake.root:
            lake.spark.catalog.refreshByPath(lake.path(table))
        else:
            lake.spark.catalog.refreshTable(lake.name(table))
    return sum(loaded)


class DropLoads(FileDropSources):
    """Control rows whose sources are folders of dropped files, of which each is read once.

    ``sql_query`` holds the folder and ``source`` the format.  ``incremental`` appends the new files,
    ``merge`` merges them by the row's ``merge_key`` (newest by the validation columns, where given); a
    full load reads the folder as it is.  Checkpoints live below ``checkpoints``, one a control row.
    """

    def __init__(self, spark: SparkSession, lake: LakeLocation, ledger: LoadLedger, checkpoints: str | None = None,
                 schema: T.StructType | str | None = None, options: dict | None = None):
        super().__init__(spark, lake, schema, options)
        self.ledger, self.checkpoints = ledger, checkpoints or f"{lake.home}/_drops"

    def load(self, entry: ControlEntry, lake: LakeLocation, batch: str) -> LoadResult | None:
        """Load a control row's new files; None if its load type is not for single files."""
        kind = (entry.loadtype or "").lower()
        if kind not in ("incremental", "merge"):
            return None
        if kind == "merge" and not entry.merge_key:
            raise ValueError("merge load needs merge_key")
        _, known = self.relation(entry)  # for its schema; nothing is read
        rows = load_drops(
            self.spark, entry.sql_query, (entry.source or "parquet").lower(), known.schema, lake, entry.tablename,
            f"{self.checkpoints}/{entry.id}-{entry.tablename}", self.ledger,
            keys=split_columns(entry.merge_key) if kind == "merge" else None,
            order_by=split_columns(entry.data_validation_column) if entry.data_validation_column else None,
            batch=batch, entry_id=entry.id, options=self.options)
        return LoadResult(rows)


def ingest_drops(spark: SparkSession, drop_path: str, fmt: str, schema: T.StructType | str,
                 target_path: str, checkpoint: str, *, options: dict | None = None,
                 partition_by: list[str] | None = None,
                 max_files_per_trigger: int | None = None) -> int:
    """Load the files that arrived since the last run; returns the rows loaded."""
    opts = reader_options(fmt, options)
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    stream = spark.readStream.schema(schema).format(fmt).options(**opts).load(drop_path)
    # Every batch reports its rows under this name; the progress log keeps only the last ones.
    name = f"drops-{uuid.uuid4().hex[:12]}"
    counter = _RowCounter(name)
    stream = stream.observe(name, F.count(F.lit(1)).alias("rows"))
    writer = (stream.writeStream.format("parquet").option("path", target_path)
              .option("checkpointLocation", checkpoint).outputMode("append")
              .trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    spark.streams.addListener(counter)
    try:
        q = writer.start()
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        counter.ended.wait(60)
    finally:
        spark.streams.removeListener(counter)
    return counter.rows


class _RowCounter(StreamingQueryListener):
    """Adds up the rows that the batches of one query report."""

    def __init__(self, name: str):
        self.name, self.rows, self.ended = name, 0, threading.Event()
        self.query = None

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        found = event.progress.observedMetrics.get(self.name)
        if found is not None:
            self.query = event.progress.runId
            self.rows += found["rows"]

    def onQueryTerminated(self, event):
        # Events come in order; another query's end says nothing about this one.
        if self.query is None or event.runId == self.query:
            self.ended.set()
