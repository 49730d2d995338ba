"""Control-table driven loads into the lake (ING-1..ING-4, SNK-3, SNK-4).

* full load: replace the target with the extract (ING-1);
* incremental load: append the rows past the high-water mark and advance the
  mark to the largest value loaded (ING-2);
* merge load: upsert the rows past the mark by key (ING-3);
* a run: every active control row of a group in priority order, one run
  audit row each (ING-4, SNK-4).

Every load stages its rows beside the target, in the target's layout, counts them there
(file footers) and only then publishes them by renames (:mod:`.publish`): an extract
that fails half-way leaves the target as it was, and a publication that is cut off is
finished by the next call.  With a :class:`~.ledger.LoadLedger` a run that is
repeated after a lost driver appends nothing twice.

Row counts and new marks come from ``Observation`` metrics gathered while the
extract is read.  A merge reads its source once, into the shared scratch
folder: keys, touched partitions and written rows all come from that copy, so a
source that moves (or a tie that falls another way) cannot make them
disagree.  On a partitioned target only the partitions holding updated keys are
written and swapped in (SNK-3).  Keys and partition values are compared null-safe:
NULL is a value like any other.

A target keeps its layout: partition columns, provider, location, comment and table
properties are taken from it unless given.
"""

from __future__ import annotations

import datetime as dt
import re
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.formatting import hms, truncate_error
from lakeops.functions.joins import null_safe_join
from lakeops.functions.predicates import first_of, pending, split_columns
from lakeops.operators.control import ControlEntry
from lakeops.operators.ledger import LoadLedger, mark_text as _mark_text
from lakeops.operators.publish import (APPEND, REPLACE, REWRITE, SWAP, Done, Files, Publication, Watch, finish, publish,
                                       stage_path)
from lakeops.session import drop_scratch, scratch_path


# Formats whose files may be moved into a table as they are.
_MOVABLE = ("parquet", "orc")


@dataclass
class LakeLocation:
    """Where lake tables live: Parquet folders under ``root`` or a catalog database.

    ``watch`` is told of every step of a publication (table, step).
    """

    spark: SparkSession
    root: str | None = None
    database: str | None = None
    row_level_merge: bool = False  # catalog tables that support MERGE (e.g. Iceberg)
    watch: Watch | None = None

    def name(self, table: str) -> str:
        return f"{self.database}.{table}" if self.database else table

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def home(self) -> str:
        """The folder that stages and publication records go to: beside the tables."""
        if self.root:
            return self.root.rstrip("/")
        database = self.database or self.spark.catalog.currentDatabase()
        return self.spark.catalog.getDatabase(database).locationUri.rstrip("/")

    def exists(self, table: str) -> bool:
        if self.root:
            return Files(self.spark).exists(self.path(table))
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        if self.root:
            return self.spark.read.parquet(self.path(table))
        return self.spark.table(self.name(table))

    def partitions(self, table: str) -> list[str]:
        """Partition columns of an existing target, in folder order."""
        if self.root:
            return _folder_partitions(self.spark, self.path(table))
        return [c.name for c in self.spark.catalog.listColumns(self.name(table)) if c.isPartition]

    def described(self, table: str, key: str) -> str | None:
        return self.details(table).get(key)

    def details(self, table: str) -> dict[str, str]:
        """What the catalog says of a table beside its columns (``Provider``, ``Location``, ``Type`` ...)."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").collect()
        detail = next((i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed")), len(rows))
        return {r["col_name"]: r["data_type"] for r in rows[detail + 1:]}

    def finish(self, table: str, done: Done | None = None) -> Publication | None:
        """Carry out what an interrupted load of this table left to do."""
        return finish(self.spark, self.home, table, None if self.root else self.name(table), done, self.watch)

    def stage(self, df: DataFrame, table: str, partition_by: list[str] | None) -> "Stage":
        """Write ``df`` beside the table, in the layout it will have there."""
        existing = not self.root and self.exists(table)
        about = self.details(table) if existing else {}
        provider = "parquet" if self.root else about.get("Provider", "parquet").lower()
        columns = self.spark.table(self.name(table)).columns if existing else df.columns
        # The same columns: files can be moved as they are; else Spark writes the table from the stage.
        same = existing and sorted(columns) == sorted(df.columns) and dict(df.dtypes) == dict(self.read(table).dtypes)
        movable = bool(self.root) or (same and provider in _MOVABLE and about.get("Num Buckets", "0") == "0")
        if same:
            df = df.select(*columns)
        path = stage_path(self.home, table)
        writer = df.write.format(provider if movable else "parquet")
        if partition_by and movable:
            writer = writer.partitionBy(*partition_by)
        writer.save(path)
        rewrite = None
        if not movable:
            rewrite = {"schema": df.schema.json(), "provider": provider, "insert": same, "comment": about.get("Comment"),
                       "location": about.get("Location") if about.get("Type") == "EXTERNAL" else None,
                       "properties": self._properties(table) if existing else {}}
        target = self.path(table) if self.root else unquote(about.get("Location", ""))
        return Stage(self, table, path, df.schema, list(partition_by or []), target, movable, rewrite,
                     provider if movable else "parquet")

    def _properties(self, table: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return {r["key"]: r["value"] for r in rows if not r["key"].startswith(("transient_", "spark.", "option."))}


@dataclass
class Stage:
    """Rows written beside their table, ready to be published."""

    lake: LakeLocation
    table: str
    path: str
    schema: T.StructType
    partition_by: list[str]
    target: str
    movable: bool
    rewrite: dict | None
    fmt: str

    def read(self) -> DataFrame:
        return self.lake.spark.read.schema(self.schema).format(self.fmt).load(self.path)

    def check(self, expected: int) -> None:
        """Refuse a stage from which not all rows can be read back (file footers only)."""
        found = self.read().count()
        if found < expected:
            Files(self.lake.spark).delete(self.path)
            raise RuntimeError(f"{self.table}: {expected} rows written, {found} can be read back")

    def _publish(self, kind: str, gone: Sequence[str] = (), note: dict | None = None, done: Done | None = None) -> None:
        files = Files(self.lake.spark)
        parts = list(files.folders(self.path, len(self.partition_by))) if self.partition_by and self.movable else []
        what = Publication(kind, self.table, self.target, self.path, self.partition_by, parts,
                           sorted(set(gone) - set(parts)), self.rewrite, note)
        publish(self.lake.spark, self.lake.home, what, None if self.lake.root else self.lake.name(self.table), done,
                self.lake.watch)

    def replace(self, note: dict | None = None, done: Done | None = None) -> None:
        """The whole table becomes the staged rows."""
        self._publish(REPLACE if self.movable else REWRITE, (), note, done)

    def append(self, note: dict | None = None, done: Done | None = None) -> None:
        """The staged rows join the table.

        Where files cannot be moved, Spark's own append does it, which a lost driver may leave undecided.
        """
        lake = self.lake
        if not self.target or not lake.exists(self.table):
            self.replace(note, done)
        elif self.movable:
            self._publish(APPEND, (), note, done)
        else:
            name = lake.name(self.table)
            self.read().select(*lake.spark.table(name).columns).write.insertInto(name)
            if done and note is not None:
                done(note)
            Files(lake.spark).delete(self.path)

    def swap(self, old: Sequence[str], note: dict | None = None, done: Done | None = None) -> None:
        """The staged partitions take the place of those in the table; of the ``old`` ones, those not staged go."""
        lake = self.lake
        if self.movable:
            self._publish(SWAP, old, note, done)
            return
        # Replacing partitions is repeatable by itself.
        spark, name = lake.spark.newSession(), lake.name(self.table)
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        rows = spark.read.schema(self.schema).format(self.fmt).load(self.path)
        rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
        lake.spark.catalog.refreshTable(name)
        if done and note is not None:
            done(note)
        Files(lake.spark).delete(self.path)


def _folder_partitions(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a Parquet folder, from the names of its first sub-folders."""
    found: list[str] = []
    files = Files(spark)
    while True:
        below = next(files.folders(path, 1), None)
        if below is None:
            return found
        path = f"{path}/{below}"
        found.append(below.split("=", 1)[0])


def _staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared scratch folder and read back with its own schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@dataclass
class LoadResult:
    rows: int
    new_mark: object = None


def _columns(mark_col: str | Sequence[str] | None) -> list[str]:
    return [] if mark_col is None else [mark_col] if isinstance(mark_col, str) else list(mark_col)


def _observed(df: DataFrame, mark_col: str | Sequence[str] | None = None) -> tuple[DataFrame, Observation]:
    obs = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    cols = _columns(mark_col)
    if cols:
        metrics.append(F.max(first_of([F.col(c) for c in cols])).alias("mark"))
    return df.observe(obs, *metrics), obs


def load_full(df: DataFrame, lake: LakeLocation, table: str, partition_by: list[str] | None = None,
              mark_col: str | Sequence[str] | None = None, note: dict | None = None,
              done: Done | None = None) -> LoadResult:
    """Replace the target with the extract (ING-1); with ``mark_col``, also report the largest value loaded.

    The extract is staged and counted first, so one that fails half-way leaves the target as it was.
    """
    lake.finish(table, done)
    if partition_by is None and lake.exists(table):
        partition_by = lake.partitions(table)
    df, obs = _observed(df, mark_col)
    staged = lake.stage(df, table, partition_by)
    m = obs.get
    staged.check(m["rows"])
    staged.replace(_noted(note, m["rows"], m.get("mark")), done)
    return LoadResult(m["rows"], m.get("mark"))


def _noted(note: dict | None, rows: int, mark) -> dict | None:
    """What the ledger is told once the rows are in place."""
    return None if note is None else {**note, "ROWS_LOADED": rows, "NEW_MARK": _mark_text(mark)}


def load_incremental(source: DataFrame, lake: LakeLocation, table: str, mark_col: str | Sequence[str],
                     mark, partition_by: list[str] | None = None, note: dict | None = None,
                     done: Done | None = None) -> LoadResult:
    """Append rows past the mark; the new mark is the largest value loaded (ING-2).

    Of several mark columns the first that is not null counts.  Without a mark
    (a table's first load) every row is loaded.
    """
    lake.finish(table, done)
    rows = source if mark is None else source.where(pending(mark_col, mark))
    if lake.exists(table):
        partition_by = partition_by or lake.partitions(table)
    df, obs = _observed(rows, mark_col)
    staged = lake.stage(df, table, partition_by)
    m = obs.get
    staged.check(m["rows"])
    new_mark = m.get("mark") if m.get("rows") else mark
    if mark is not None and (new_mark is None or new_mark < mark):
        new_mark = mark
    staged.append(_noted(note, m["rows"], new_mark), done)
    return LoadResult(m["rows"], new_mark)


def latest_per_key(df: DataFrame, keys: list[str], order_by: str | Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the largest ``order_by``; of equal ones, or
    without it, the one whose other columns have the largest hash.

    Of several order columns the first that is not null counts.  NULL keys are
    one key.  An aggregation, not a window: partial aggregation collapses each key
    on the map side, so a key holding a third of all rows never reaches one task
    as a third of all rows.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    order = [first_of([F.col(c) for c in _columns(order_by)]).alias("o")] if _columns(order_by) else []
    picked = df.groupBy(*keys).agg(F.max_by(
        F.struct(*[F.col(c) for c in others]),
        F.struct(*order, F.xxhash64(*[F.col(c) for c in others]).alias("h"))).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def touched_partitions(current: DataFrame, updates: DataFrame, keys: list[str],
                       partition_by: list[str]) -> DataFrame:
    """Partitions holding an updated key, plus those receiving an update."""
    return (null_safe_join(current, updates.select(*keys), keys).select(*partition_by)
            .unionByName(updates.select(*partition_by)).distinct())


def in_partitions(df: DataFrame, touched: DataFrame) -> DataFrame:
    """The rows of ``df`` in the partitions of ``touched``.

    Partitions without NULL are joined by plain equality, which Spark turns into
    a partition filter at run time (it does not for null-safe equality); those
    with one are a static partition filter of their own.
    """
    cols = touched.columns
    no_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return (df.where(no_null).join(touched.where(no_null), cols, "left_semi").select(*df.columns)
            .unionByName(null_safe_join(df.where(~no_null), touched, cols)))


def merged_rows(current: DataFrame, updates: DataFrame, keys: list[str], partition_by: list[str] | None = None,
                touched: DataFrame | None = None) -> DataFrame:
    """``updates ∪ (current rows whose key is not updated)``, by key (ING-3).

    With ``partition_by``, only the partitions that hold an updated key (or
    receive an update) are produced; the others need no rewrite.
    """
    if partition_by and touched is None:
        touched = touched_partitions(current, updates, keys, partition_by)
    scope = current if touched is None else in_partitions(current, touched)
    kept = null_safe_join(scope, updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates.select(*current.columns))


def load_merge(source: DataFrame, lake: LakeLocation, table: str, keys: list[str],
               mark_col: str | Sequence[str] | None = None, mark=None,
               order_by: str | Sequence[str] | None = None, partition_by: list[str] | None = None,
               unique_keys: bool = False, note: dict | None = None, done: Done | None = None) -> LoadResult:
    """Upsert the rows past the mark into the target by key (ING-3).

    Updates are reduced to one row per key first: the newest by ``order_by``,
    which is the mark unless given.  ``unique_keys=True`` skips that aggregation
    when the source guarantees it (a primary key), saving a shuffle of the
    updates.  The new mark comes from the extract before that reduction.
    """
    spark = source.sparkSession
    lake.finish(table, done)
    extract, obs = _observed(source.where(pending(mark_col, mark)) if _columns(mark_col) and mark is not None
                             else source, mark_col)
    updates = extract if unique_keys else latest_per_key(extract, keys, order_by or mark_col)
    updates, updates_path = _staged(updates, f"updates-{table}")
    m = obs.get
    result = LoadResult(updates.count(), m.get("mark") if m.get("rows") and m.get("mark") is not None else mark)
    note = _noted(note, result.rows, result.new_mark)
    if not lake.exists(table):
        staged = lake.stage(updates, table, partition_by)
        staged.check(result.rows)
        staged.replace(note, done)
    elif lake.row_level_merge:
        # The table format rewrites only the files holding matched keys.
        # (Not exercised here: no such catalog is available locally.)
        cond = " AND ".join(f"{table}.{k} <=> s.{k}" for k in keys)
        (updates.alias("s").mergeInto(lake.name(table), F.expr(cond))
         .whenMatched().updateAll().whenNotMatched().insertAll().merge())
        if done and note is not None:
            done(note)
    elif result.rows:
        _merge_partitions(lake, table, updates, keys, partition_by or lake.partitions(table), note, done)
    elif done and note is not None:
        done(note)
    drop_scratch(spark, updates_path)
    return result


def _merge_partitions(lake: LakeLocation, table: str, updates: DataFrame, keys: list[str],
                      partition_by: list[str], note: dict | None, done: Done | None) -> None:
    """The merged rows of the touched partitions are staged in their layout, counted, and swapped in."""
    spark, current = lake.spark, lake.read(table)
    touched, scratch = None, None
    if partition_by:
        touched, scratch = _staged(touched_partitions(current, updates, keys, partition_by), f"touched-{table}")
    merged, obs = _observed(merged_rows(current, updates, keys, partition_by, touched).select(*current.columns))
    staged = lake.stage(merged, table, partition_by)
    staged.check(obs.get["rows"])
    if partition_by:
        staged.swap(_folders_of(current, touched, staged.target), note, done)
        drop_scratch(spark, scratch)
    else:
        staged.replace(note, done)


def _folders_of(df: DataFrame, touched: DataFrame, target: str) -> list[str]:
    """The folders below ``target`` that hold rows of the touched partitions (one row per folder)."""
    rows = df.select(*touched.columns, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder"))
    folders = [unquote(r["folder"]) for r in in_partitions(rows, touched).select("folder").distinct().collect()]
    depth = len(touched.columns)
    below = lambda path: re.sub(r"^[a-z][a-z0-9+.-]*:/*", "/", path).rstrip("/")  # noqa: E731 - without the scheme
    stray = [f for f in folders if not below(f).endswith("/".join(["", *below(target).split("/")[-1:], *f.split("/")[-depth:]]))]
    if stray:
        raise ValueError(f"partitions outside the table's folder: {stray[:3]}")
    return ["/".join(f.split("/")[-depth:]) for f in folders]


def overwrite_partitions(df: DataFrame, lake: LakeLocation, table: str,
                         partition_by: list[str]) -> None:
    """Replace only the partitions present in ``df`` (SNK-3)."""
    lake.finish(table)
    df, obs = _observed(df)
    staged = lake.stage(df, table, partition_by)
    staged.check(obs.get["rows"])
    if lake.exists(table):
        present = staged.read().select(*partition_by).distinct()
        staged.swap(_folders_of(lake.read(table), present, staged.target))
    else:
        staged.replace()


# --------------------------------------------------------------------------- a run
RUN_AUDIT_SCHEMA = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("JOB_NAME", T.StringType()),
    T.StructField("GROUPID", T.LongType()),
    T.StructField("TABLE_NAME", T.StringType()),
    T.StructField("LOAD_TYPE", T.StringType()),
    T.StructField("STATUS", T.StringType()),
    T.StructField("ROWS_LOADED", T.LongType()),
    T.StructField("OLD_MARK", T.StringType()),
    T.StructField("NEW_MARK", T.StringType()),
    T.StructField("ERROR_MESSAGE", T.StringType()),
    T.StructField("EXEC_TIME", T.StringType()),
    T.StructField("BATCH_NUMBER", T.StringType()),
])


@dataclass
class RunResult:
    succeeded: int
    failed: int
    audit: DataFrame
    marks: dict[int, object]

    def __getitem__(self, i):  # (successes, failures, audit) like a tuple
        return (self.succeeded, self.failed, self.audit)[i]


def load_entry(spark: SparkSession, entry: ControlEntry, sources, lake: LakeLocation,
               partition_by: list[str] | None = None, note: dict | None = None,
               done: Done | None = None) -> tuple[LoadResult, object]:
    """Run the load a control row asks for; returns the result and the old mark."""
    _, df = sources.relation(entry, for_load=True)
    kind = (entry.loadtype or "").lower()
    mark = entry.offset_value if entry.offset_value is not None else entry.startdatetime
    told = {"note": note, "done": done}
    if entry.loadtype == "Full Load":
        return load_full(df, lake, entry.tablename, partition_by, **told), None
    if kind in ("incremental", "merge"):
        cols = split_columns(entry.data_validation_column)
        if kind == "incremental":
            return load_incremental(df, lake, entry.tablename, cols, mark, partition_by, **told), mark
        if not entry.merge_key:
            raise ValueError("merge load needs merge_key")
        return load_merge(df, lake, entry.tablename, split_columns(entry.merge_key),
                          cols, mark, None, partition_by, **told), mark
    raise ValueError(f"unknown load type {entry.loadtype!r}")


def run_ingestion(spark: SparkSession, entries: list[ControlEntry], sources,
                  lake: LakeLocation, *, job_name: str, batch: str,
                  max_parallel: int = 1, ledger: LoadLedger | None = None,
                  on_row: Callable[[DataFrame], None] | None = None) -> RunResult:
    """Load every entry; one failure never stops the rest (ING-4).

    The loop runs over configuration rows; each iteration is Spark jobs over
    a whole table.  ``max_parallel > 1`` runs that many loads at once (Spark
    schedules concurrent jobs from driver threads), which keeps a large
    cluster busy when many tables are small; rows stay in priority order.
    Entries must then target distinct tables.

    With a ``ledger``, a load starts from the mark that the ledger has committed
    past the control row's, and commits its own once its rows are in place.
    ``on_row`` gets each table's audit row as soon as that table is done.
    """
    def one(e: ControlEntry):
        t0 = time.monotonic()
        try:
            note, done = None, None
            if ledger is not None:
                done = ledger.commit
                lake.finish(e.tablename, done)
            # Sources that know themselves what is new (dropped files) keep their own account of it.
            own = getattr(sources, "load", None)
            res, old = (own(e, lake, batch) if own else None), None
            if res is None:
                if ledger is not None:
                    e = ledger.resumed(e, lake.exists(e.tablename))
                    note = ledger.intend(e, batch)
                res, old = load_entry(spark, e, sources, lake, note=note, done=done)
            row = (e.id, job_name, e.groupid, e.tablename, e.loadtype, "SUCCESS", res.rows,
                   _mark_text(old), _mark_text(res.new_mark), None, hms(time.monotonic() - t0), batch)
            mark = res.new_mark
        except Exception as exc:  # noqa: BLE001 - recorded in the run audit
            row = (e.id, job_name, e.groupid, e.tablename, e.loadtype, "FAILED", None,
                   None, None, truncate_error(exc), hms(time.monotonic() - t0), batch)
            mark = None
        if on_row:
            on_row(spark.createDataFrame([row], RUN_AUDIT_SCHEMA))
        return e, row, mark

    if max_parallel > 1:
        with ThreadPoolExecutor(max_workers=max_parallel) as pool:
            outcomes = list(pool.map(one, entries))
    else:
        outcomes = [one(e) for e in entries]
    rows = [row for _, row, _ in outcomes]
    good = [row[5] == "SUCCESS" for row in rows]
    marks = {e.id: mark for (e, _, mark), ok in zip(outcomes, good) if ok}
    return RunResult(sum(good), len(good) - sum(good), spark.createDataFrame(rows, RUN_AUDIT_SCHEMA), marks)


def advance_marks(control: DataFrame, run: RunResult) -> DataFrame:
    """The control table with each loaded row's high-water mark moved forward."""
    spark = control.sparkSession
    ts = [(i, m, None) for i, m in run.marks.items() if isinstance(m, dt.datetime)]
    num = [(i, None, int(m)) for i, m in run.marks.items()
           if m is not None and not isinstance(m, dt.datetime)]
    if not ts and not num:
        return control
    new = spark.createDataFrame(ts + num, "id long, new_start timestamp_ntz, new_offset long")
    joined = control.join(F.broadcast(new), "id", "left")
    return joined.select(*[
        F.coalesce("new_start", "startdatetime").alias(c) if c == "startdatetime" else
        F.coalesce("new_offset", "offset_value").alias(c) if c == "offset_value" else F.col(c)
        for c in control.columns])
