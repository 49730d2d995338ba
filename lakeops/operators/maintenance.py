"""Table maintenance: compaction, snapshot expiry, orphan files, sweeps (MNT-1..4).

Each step is planned as a DataFrame over an inventory (files or snapshots),
so the plan itself is a distributed job whose size follows the inventory,
not a driver loop:

* compaction (MNT-1): files outside ``[min_ratio, max_ratio] * target`` are
  candidates; inside each table partition they are packed, in order, into
  bins of ``target`` bytes by a running sum of sizes;
* snapshot expiry (MNT-2): snapshots older than a cutoff, except the newest
  ``retain_last`` of each table;
* orphan files (MNT-3): listed files no metadata refers to, older than a
  cutoff;
* a sweep (MNT-4): every table of each database, minus excluded names, all
  steps in order; a failing step skips the rest of that table only.

On an Iceberg catalog the sweep issues the catalog's own procedures.  On
plain Parquet tables compaction is carried out here (``rewrite_bins``);
Parquet keeps no snapshot or manifest metadata, so those steps report
SKIPPED.  Deleting files is irreversible: it is off unless ``dry_run=False``.  A
swap of files is recorded first, so that a run that dies in between is finished
by the next one; readers may still see old and new files for a moment.
"""

from __future__ import annotations

import datetime as dt
import math
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.formatting import truncate_error
from lakeops.functions.joins import null_safe_join
from lakeops.functions.running import grouped_running_sum
from lakeops.session import drop_scratch, scratch_path

# Defaults of the table format's maintenance procedures, as parameters.
DEFAULT_TARGET_BYTES = 512 * 1024 * 1024
DEFAULT_MIN_RATIO = 0.75
DEFAULT_MAX_RATIO = 1.80
DEFAULT_SNAPSHOT_AGE = dt.timedelta(days=5)
DEFAULT_RETAIN_LAST = 1
DEFAULT_ORPHAN_AGE = dt.timedelta(days=3)
# Folder of a swap in progress, beside a table's files; readers skip names with this beginning.
SWAP_PREFIX = "_compaction-"
# What a task reads at once of a file to be split; the files that a task of a partitioned write keeps open.
SPLIT_BYTES = 128 * 1024 * 1024
OPEN_FILES = 4
# Fixed value: table names containing this token are left out of a sweep.
EXCLUDE_TOKEN = "d1_"
# The maintenance steps, in the order they run.
STEPS = ("rewrite_data_files", "rewrite_manifests", "expire_snapshots", "remove_orphan_files")


# --------------------------------------------------------------------------- inventory
def file_inventory(spark: SparkSession, table_path: str) -> DataFrame:
    """Data files of a Parquet table: ``path, folder, size, modified`` plus partition columns.

    A listing only; no file content is read.  ``folder`` is the file's partition
    as it is spelled (partition columns have inferred types, which may not tell
    ``01`` from ``1``).
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
          .load(table_path))
    return df.drop("content").withColumnRenamed("length", "size") \
        .withColumnRenamed("modificationTime", "modified") \
        .withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))


# --------------------------------------------------------------------------- MNT-1
def compaction_plan(inventory: DataFrame, *, partition_cols: Sequence[str], order_col: str,
                    size_col: str = "size", tie_cols: Sequence[str] = (),
                    target_bytes: int = DEFAULT_TARGET_BYTES,
                    min_ratio: float = DEFAULT_MIN_RATIO, max_ratio: float = DEFAULT_MAX_RATIO,
                    min_input_files: int = 1, chunks: int | None = None) -> DataFrame:
    """Candidate files with their bin: ``... , bytes_before, bin``.

    ``bin = floor(bytes of earlier candidates in the partition / target)``.
    With ``min_input_files > 1``, bins with fewer files are dropped unless
    they hold a file that must be split.
    """
    # Integer bounds (sizes are whole bytes) keep the predicate pushable to the scan.
    lo, hi = math.ceil(target_bytes * min_ratio), math.floor(target_bytes * max_ratio)
    cand = inventory.where((F.col(size_col) < F.lit(lo)) | (F.col(size_col) > F.lit(hi)))
    ranked = grouped_running_sum(cand, partition_cols, order_col, size_col, "bytes_before",
                                 tie_cols=tie_cols, chunks=chunks)
    planned = ranked.withColumn("bin", (F.col("bytes_before") / F.lit(target_bytes)).cast("long"))
    if min_input_files > 1:
        keys = [*partition_cols, "bin"]
        big = planned.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                         F.max(size_col).alias("_max"))
        keep = big.where((F.col("_n") >= min_input_files) | (F.col("_max") > hi)).select(*keys)
        planned = null_safe_join(planned, keep, keys)
    return planned


def compaction_summary(plan: DataFrame, partition_cols: Sequence[str],
                       size_col: str = "size") -> DataFrame:
    """One row per bin: files in, bytes in."""
    return plan.groupBy(*partition_cols, "bin").agg(
        F.count(F.lit(1)).alias("files"), F.sum(size_col).alias("bytes"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_files(spark: SparkSession, paths: DataFrame, path_col: str = "path",
                 dry_run: bool = True) -> int:
    """Delete the listed files (paths as they are, not URL-encoded); returns how many.

    Paths stream to the driver one partition at a time and are deleted by a few
    threads; a file that cannot be deleted raises.
    """
    def remove(row) -> None:
        fs, p = _fs(spark, row[0])
        if not fs.delete(p, False) and fs.exists(p):
            raise OSError(f"could not delete {row[0]}")

    rows = paths.select(path_col).toLocalIterator()
    n = 0
    with ThreadPoolExecutor(max_workers=8) as pool:
        while batch := list(islice(rows, 1000)):
            n += len(batch)
            if not dry_run:
                list(pool.map(remove, batch))
    return n


@dataclass
class CompactionResult:
    files_in: int
    bins: int
    files_removed: int
    dry_run: bool


def compaction_schema(spark: SparkSession, table_path: str, partition_cols: Sequence[str],
                      schema: T.StructType | None = None) -> T.StructType:
    """What to read files with: every column any of them may have; partition values as spelled."""
    if schema is None:
        schema = spark.read.option("mergeSchema", "true").parquet(table_path).schema
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in partition_cols else f.dataType, True)
                         for f in schema])


def unsorted_writes(spark: SparkSession, conf: dict[str, object] | None = None) -> SparkSession:
    """A session whose partitioned writes keep a file open for each partition value of a task (few, else it sorts).

    By default Spark sorts a task's rows by partition value first, which holds the whole task.
    """
    session = spark.newSession()
    for k, v in {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES,
                 "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"), **(conf or {})}.items():
        session.conf.set(k, str(v))
    return session


def rewrite_bins(spark: SparkSession, table_path: str, plan: DataFrame,
                 partition_cols: Sequence[str], dry_run: bool = True,
                 max_files_per_job: int = 10_000, max_bins_per_job: int = 256,
                 size_col: str = "size", target_bytes: int | None = None,
                 max_ratio: float = DEFAULT_MAX_RATIO, schema: T.StructType | None = None) -> CompactionResult:
    """Carry out a compaction plan on a Parquet table (MNT-1).

    The plan's bins are dealt to jobs by a hash, whole runs of
    ``max_bins_per_job`` bins of a folder together, so that a job has about
    ``max_files_per_job`` files; that is all the driver ever lists.  In a job, the
    small files of a folder are one scan that Spark's own splitter packs into
    tasks of ``target_bytes`` (default: the largest bin), one new file each,
    without a shuffle or a sort (a task has files of one folder); a file over the
    maximum is read in splits and dealt out to as many files as it needs.  So what a
    task holds does not grow with the target.  Files are rewritten only if there will be fewer of them or one is
    split, so a sweep that finds nothing to gain changes nothing.

    ``schema``: the table's, by the catalog (default: merged from all files), so
    that columns added later survive.  Tables written by a stream are refused:
    their readers go by the stream's own list of files.
    """
    fs, root = _fs(spark, table_path)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if fs.exists(hadoop_path(root, "_spark_metadata")):
        raise ValueError(f"{table_path} is written by a stream, whose log lists its files: not compacted here")
    if not dry_run:
        finish_swaps(spark, table_path)
    # Freeze the plan first: the listing it came from changes once new files land.
    frozen = scratch_path(spark, "compaction-plan")
    listed = plan.withColumn("_folder", F.regexp_replace("path", "/[^/]*$", "")) \
        .select("path", "_folder", "bin", F.col(size_col).cast("long").alias("_size"))
    listed.write.parquet(frozen)
    listed = spark.read.schema(listed.schema).parquet(frozen)
    per_bin = listed.groupBy("_folder", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("b"))
    files_in, bins_in, largest = per_bin.agg(F.sum("n"), F.count(F.lit(1)), F.max("b")).first()
    if not files_in:
        drop_scratch(spark, frozen)
        return CompactionResult(0, 0, 0, dry_run)
    target = target_bytes or largest
    if dry_run:
        drop_scratch(spark, frozen)
        return CompactionResult(files_in, bins_in, 0, True)
    n_jobs = max(-(-files_in // max_files_per_job), -(-bins_in // max_bins_per_job))
    run = F.floor(F.col("bin") / max_bins_per_job)
    keyed = listed.withColumn("_run", run).withColumn("_job", F.pmod(F.xxhash64("_folder", "_run"), F.lit(n_jobs)))
    # Sessions of their own pack scans by the target, or split them, whatever the caller's settings are.
    packer, splitter = (unsorted_writes(spark, {
        "spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 0,
        "spark.sql.files.minPartitionNum": 1, "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"})
        for size in (target, min(target, SPLIT_BYTES)))
    read_as = compaction_schema(spark, table_path, partition_cols, schema)

    def scan(paths, session=packer):
        return session.read.schema(read_as).option("basePath", table_path).parquet(*paths)

    removed = made = 0
    for job in range(n_jobs):
        groups: dict[tuple, list] = {}
        for r in keyed.where(F.col("_job") == job).collect():
            groups.setdefault((r["_folder"], r["_run"]), []).append((r["path"], r["_size"]))
        parts, old = [], []
        for files in groups.values():
            for path, size in files:
                if size > target * max_ratio:
                    parts.append(scan([path], splitter).repartition(-(-size // target)))
                    old.append(path)
            small = [path for path, size in files if size <= target * max_ratio]
            packed = scan(small) if len(small) > 1 else None
            if packed is not None and packed.rdd.getNumPartitions() < len(small):
                parts.append(packed)
                old += small
        if parts:
            out = reduce(lambda a, b: a.unionByName(b), parts)
            made += out.rdd.getNumPartitions()
            _swap(spark, table_path, out, old, partition_cols)
            removed += len(old)
    drop_scratch(spark, frozen)
    return CompactionResult(files_in, made, removed, False)


def _swap(spark: SparkSession, table_path: str, out: DataFrame, old: list[str], partition_cols: Sequence[str]) -> None:
    """Replace the files ``old`` by ``out``, in steps that a later run can finish.

    New files are written beside the table's, out of readers' sight, together
    with the list of old ones; only then is the swap marked as ready.
    """
    folder = f"{table_path.rstrip('/')}/{SWAP_PREFIX}{uuid.uuid4().hex[:12]}"
    writer = out.write.partitionBy(*partition_cols) if partition_cols else out.write
    writer.parquet(f"{folder}/new")
    spark.createDataFrame([(p,) for p in old], "path string").write.parquet(f"{folder}/old")
    fs, ready = _fs(spark, f"{folder}/ready")
    fs.create(ready).close()
    finish_swaps(spark, table_path)


def finish_swaps(spark: SparkSession, table_path: str) -> int:
    """Finish the swaps that are ready, undo the others; returns how many were finished.

    One run at a time may compact a table.
    """
    fs, root = _fs(spark, table_path)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = 0
    for st in fs.listStatus(root) if fs.exists(root) else []:
        folder = st.getPath()
        if not folder.getName().startswith(SWAP_PREFIX):
            continue
        if fs.exists(hadoop_path(folder, "ready")):
            new = hadoop_path(folder, "new")
            found, base = fs.listFiles(new, True), fs.makeQualified(new).toUri().getPath()
            while found.hasNext():
                path = found.next().getPath()
                if path.getName().startswith(("_", ".")):
                    continue
                to = hadoop_path(f"{table_path.rstrip('/')}{path.toUri().getPath()[len(base):]}")
                fs.mkdirs(to.getParent())
                if not fs.rename(path, to):
                    raise OSError(f"could not move {path} to {to}")
            old = spark.read.schema("path string").parquet(hadoop_path(folder, "old").toString())
            delete_files(spark, old, dry_run=False)
            done += 1
        if not fs.delete(folder, True):
            raise OSError(f"could not remove {folder}")
    return done


# --------------------------------------------------------------------------- MNT-2
def _cutoff(value, age: dt.timedelta, dtype):
    """A cut-off instant of the column's type: ``value`` if given, else now - age."""
    if value is None:
        now = F.current_timestamp().cast(dtype)
        return now - F.make_dt_interval(secs=F.lit(age.total_seconds()).cast("decimal(18,6)"))
    if isinstance(value, dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    if isinstance(value, dt.date):
        return F.lit(value.isoformat()).cast(dtype)
    return value if hasattr(value, "alias") else F.lit(value)


def expired_snapshots(snapshots: DataFrame, *, table_cols: Sequence[str], time_col: str,
                      id_col: str, older_than=None,
                      retain_last: int = DEFAULT_RETAIN_LAST) -> DataFrame:
    """Snapshots to expire: older than ``older_than`` (default: five days ago)
    and not among the newest ``retain_last`` of their table.

    The newest ``retain_last`` per table come from a ``row_number() <= k``
    filter, which Spark evaluates with a partial per-task limit before the
    shuffle, so a table with a third of all snapshots ships only ``k`` rows
    per task.  Their oldest is the table's keep-from point, joined back to
    every snapshot (one row per table).
    """
    t = list(table_cols)
    w = Window.partitionBy(*t).orderBy(F.col(time_col).desc(), F.col(id_col).desc())
    newest = snapshots.select(*t, time_col, id_col).withColumn("_rn", F.row_number().over(w)) \
        .where(F.col("_rn") <= retain_last)
    keep_from = newest.groupBy(*t).agg(
        F.min(F.struct(F.col(time_col).alias("t"), F.col(id_col).alias("i"))).alias("_keep_from"))
    cutoff = _cutoff(older_than, DEFAULT_SNAPSHOT_AGE, snapshots.schema[time_col].dataType)
    return (null_safe_join(snapshots, keep_from, t, "inner")
            .where((F.col(time_col) < cutoff)
                   & (F.struct(F.col(time_col).alias("t"), F.col(id_col).alias("i"))
                      < F.col("_keep_from")))
            .drop("_keep_from"))


# --------------------------------------------------------------------------- MNT-3
def same_path(path: Column) -> Column:
    """A path without what differs between names of one file: ``s3``, ``s3a`` and ``s3n``, repeated slashes."""
    return F.regexp_replace(F.regexp_replace(path, "^s3[an]:", "s3:"), "(?<!:)/{2,}", "/")


def orphan_files(listing: DataFrame, referenced: DataFrame, *, on: str | Sequence[str],
                 modified_col: str | None, older_than=None) -> DataFrame:
    """Listed files no metadata refers to (MNT-3).

    Only files older than ``older_than`` (default: three days ago) by
    ``modified_col`` count, so files of a write still in progress are spared;
    ``None`` there must be said on purpose.  Text keys are compared as paths.
    """
    keys = [on] if isinstance(on, str) else list(on)
    text = {f.name for f in listing.schema if isinstance(f.dataType, T.StringType)}
    known = referenced.select(*[(same_path(F.col(k)) if k in text else F.col(k)).alias(f"_ref_{k}") for k in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & ((same_path(listing[k]) if k in text else listing[k]) == known[f"_ref_{k}"])
    out = listing.join(known, cond, "left_anti")
    if modified_col is not None:
        dtype = listing.schema[modified_col].dataType
        cutoff = F.lit(older_than) if isinstance(older_than, (int, float)) else \
            _cutoff(older_than, DEFAULT_ORPHAN_AGE, dtype)
        out = out.where(F.col(modified_col) < cutoff)
    return out


# Directory-name prefixes Spark's writers leave behind when a write dies
# (the file committer's work area; dynamic partition overwrite's staging area).
WRITE_LEFTOVER_PREFIXES = ("_temporary", ".spark-staging")


def stale_write_leftovers(spark: SparkSession, table_path: str,
                          older_than: dt.timedelta = DEFAULT_ORPHAN_AGE) -> list[str]:
    """Work directories of failed writes at a Parquet table's root (MNT-3).

    Readers skip them, so no metadata refers to them: they are the orphans of
    a plain Parquet table.  Only those count in which no file is newer than
    ``older_than``, so a write still in progress is never caught; where the
    store keeps no times (0), nothing does.
    """
    fs, root = _fs(spark, table_path)
    if not fs.exists(root):
        return []
    jvm = spark.sparkContext._jvm
    cutoff = jvm.java.lang.System.currentTimeMillis() - int(older_than.total_seconds() * 1000)

    def newest(folder: object) -> int:
        """Of the newest file inside; of the folder itself if there is none."""
        found, times = fs.listFiles(folder, True), []
        while found.hasNext():
            times.append(found.next().getModificationTime())
        return max(times, default=fs.getFileStatus(folder).getModificationTime())

    return [st.getPath().toString() for st in fs.listStatus(root)
            if st.isDirectory() and st.getPath().getName().startswith(WRITE_LEFTOVER_PREFIXES)
            and 0 < newest(st.getPath()) < cutoff]


# --------------------------------------------------------------------------- MNT-4
def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Table names of a database (SRC-6)."""
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


def without_excluded(names: DataFrame, token: str = EXCLUDE_TOKEN, col: str = "name") -> DataFrame:
    """Drop names containing ``token`` anywhere (FLT-7)."""
    return names.where(~F.col(col).contains(token))


_PLAIN_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


class IcebergProcedures:
    """Maintenance through an Iceberg catalog's stored procedures."""

    def __init__(self, spark: SparkSession, catalog: str):
        self.spark, self.catalog = spark, catalog

    def run(self, step: str, database: str, table: str) -> str:
        for name in (self.catalog, step, database, table):
            if not _PLAIN_NAME.match(name):
                raise ValueError(f"not a plain identifier: {name!r}")
        self.spark.sql(f"CALL {self.catalog}.system.{step}(table => '{database}.{table}')").collect()
        return "SUCCESS"


@dataclass
class ParquetMaintenance:
    """Maintenance of plain Parquet catalog tables: compaction and removal of
    failed writes' leftovers; manifests and snapshots do not exist there."""

    spark: SparkSession
    target_bytes: int = DEFAULT_TARGET_BYTES
    dry_run: bool = True
    results: dict = field(default_factory=dict)

    def run(self, step: str, database: str, table: str) -> str:
        if step not in ("rewrite_data_files", "remove_orphan_files"):
            return "SKIPPED"   # no manifests or snapshots in plain Parquet
        name = f"{database}.{table}"
        loc = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}") \
            .where(F.col("col_name") == "Location").first()["data_type"]
        if step == "remove_orphan_files":
            leftovers = stale_write_leftovers(self.spark, loc)
            if not self.dry_run:
                for path in leftovers:
                    fs, p = _fs(self.spark, path)
                    fs.delete(p, True)
            self.results[(database, table, step)] = leftovers
            return "PLANNED" if self.dry_run else "SUCCESS"
        parts = [c.name for c in self.spark.catalog.listColumns(name) if c.isPartition]
        plan = compaction_plan(file_inventory(self.spark, loc), partition_cols=["folder"], order_col="modified",
                               tie_cols=["path"], target_bytes=self.target_bytes)
        res = rewrite_bins(self.spark, loc, plan, parts, dry_run=self.dry_run,
                           target_bytes=self.target_bytes, schema=self.spark.table(name).schema)
        self.results[(database, table)] = res
        if not self.dry_run:
            self.spark.catalog.refreshTable(name)
        return "PLANNED" if res.dry_run else "SUCCESS"


SWEEP_SCHEMA = T.StructType([
    T.StructField("DATABASE", T.StringType()),
    T.StructField("TABLE_NAME", T.StringType()),
    T.StructField("STEP", T.StringType()),
    T.StructField("STATUS", T.StringType()),
    T.StructField("MESSAGE", T.StringType()),
])


def sweep(spark: SparkSession, databases: Sequence[str], backend, *,
          exclude_token: str = EXCLUDE_TOKEN, steps: Sequence[str] = STEPS,
          max_parallel: int = 1) -> DataFrame:
    """All steps on every table of each database, in order (MNT-4).

    Excluded tables get one EXCLUDED row.  When a step fails, the table's
    remaining steps are reported NOT_RUN and the sweep moves on.  Tables are
    independent, so ``max_parallel > 1`` maintains that many at once.
    """
    def one(db: str, name: str) -> list[tuple]:
        if exclude_token and exclude_token in name:
            return [(db, name, None, "EXCLUDED", None)]
        out, failed = [], False
        for step in steps:
            if failed:
                out.append((db, name, step, "NOT_RUN", None))
                continue
            try:
                out.append((db, name, step, backend.run(step, db, name), None))
            except Exception as exc:  # noqa: BLE001 - recorded per step
                failed = True
                out.append((db, name, step, "FAILED", truncate_error(exc)))
        return out

    tables = [(db, name) for db in databases for name in list_tables(spark, db)]
    if max_parallel > 1:
        with ThreadPoolExecutor(max_workers=max_parallel) as pool:
            results = list(pool.map(lambda t: one(*t), tables))
    else:
        results = [one(db, name) for db, name in tables]
    return spark.createDataFrame([r for rows in results for r in rows], SWEEP_SCHEMA)
