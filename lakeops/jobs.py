"""Job entry points: validation, ingestion and maintenance runs.

    python -m lakeops.jobs validate --control fw.etl_master --group 1 \\
        --audit fw.data_validation --job-name MY_VALIDATION [--lake-db lake]
    python -m lakeops.jobs ingest --control fw.etl_master --group 1 \\
        --lake-db lake --audit fw.ingestion_audit
    python -m lakeops.jobs maintain --databases lake other_db [--iceberg-catalog cat] [--apply]

Each job reads its control table (or catalog), does its work as Spark jobs
and appends one audit row per table.  Credentials and connection details for
JDBC sources come in as arguments (``--jdbc-url`` etc.), never from code.
"""

from __future__ import annotations

import argparse
import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeops.functions.formatting import batch_number, hms_words
from lakeops.operators.audit import append_audit, append_once
from lakeops.operators.control import control_scan, ingestion_scan, to_entries
from lakeops.operators.ingest import LakeLocation, advance_marks, load_full, run_ingestion
from lakeops.operators.ledger import LoadLedger
from lakeops.operators.maintenance import IcebergProcedures, ParquetMaintenance, sweep
from lakeops.operators.reconcile import ReconcileResult, run_reconcile
from lakeops.session import build_session
from lakeops.sources.jdbc import JdbcRelations, JdbcSource
from lakeops.sources.lake import LakeTables, SparkSources
from lakeops.streaming.file_drop import DropLoads

log = logging.getLogger("lakeops.jobs")

@dataclass
class ValidationRun:
    batch: str
    result: ReconcileResult


def validate(spark: SparkSession, control: DataFrame, group_id: int, *, job_name: str,
             audit_target: str | None, sources=None, lake=None, batch: str | None = None,
             mode: str = "auto", days: int = 30, lake_upper_bound: bool = False) -> ValidationRun:
    """Reconcile every active, validation-required table of a group; append the audit rows."""
    batch = batch or batch_number(group_id)
    entries = to_entries(control_scan(control, group_id))
    log.info("validating %d tables of group %s, batch %s", len(entries), group_id, batch)
    started = time.monotonic()
    # Rows are appended batch by batch: what is done is on record if the driver is lost later.
    res = run_reconcile(spark, entries, sources or SparkSources(spark), lake or LakeTables(spark),
                        job_name=job_name, batch=batch, mode=mode, days=days,
                        lake_upper_bound=lake_upper_bound,
                        on_rows=(lambda rows: append_audit(rows, audit_target)) if audit_target else None)
    log.info("validated %d tables in %s", len(entries), hms_words(time.monotonic() - started))
    for e in res.skipped:
        log.warning("unknown load type %r for table %s: no audit row", e.loadtype, e.tablename)
    return ValidationRun(batch, res)


def save_control(control: DataFrame, target: str) -> None:
    """Persist a control table, also over the table it was read from.

    The rows are staged and counted beside it and then take its place (:mod:`.operators.publish`):
    a driver lost at any moment leaves the old rows or, after the next call, the new ones.
    """
    spark = control.sparkSession
    if "/" in target or ":" in target:
        root, _, table = target.rstrip("/").rpartition("/")
        lake = LakeLocation(spark, root=root)
    else:
        database, _, table = target.rpartition(".")
        lake = LakeLocation(spark, database=database or None)
    load_full(control, lake, table)


def load_ledger(spark: SparkSession, lake: LakeLocation, target: str | None = None) -> LoadLedger:
    """The ledger of a lake: by default ``_load_ledger`` (folder) or ``load_ledger`` (table) beside its tables."""
    return LoadLedger(spark, target or (lake.path("_load_ledger") if lake.root else lake.name("load_ledger")))


def ingest(spark: SparkSession, control: DataFrame, group_id: int, lake: LakeLocation, *,
           job_name: str, audit_target: str | None = None, sources=None,
           batch: str | None = None, max_parallel: int = 1, ledger_target: str | None = None):
    """Load every active table of a group in priority order.

    Returns ``(successes, failures, run audit)`` and the control table with
    advanced high-water marks (the caller decides where to persist it).  What was loaded
    is noted in the ledger beside the lake's tables, so a run that is repeated because
    the marks were not saved appends nothing twice.  Each table's audit row is appended as
    soon as the table is done, once per batch.
    """
    batch = batch or batch_number(group_id)
    entries = to_entries(ingestion_scan(control, group_id))
    ledger = load_ledger(spark, lake, ledger_target)
    keys = ["BATCH_NUMBER", "ID", "TABLE_NAME", "STATUS"]
    run = run_ingestion(spark, entries, sources or SparkSources(spark), lake,
                        job_name=job_name, batch=batch, max_parallel=max_parallel, ledger=ledger,
                        on_row=(lambda row: append_once(row, audit_target, keys)) if audit_target else None)
    return run, advance_marks(control, run)


def maintain(spark: SparkSession, databases: list[str], *, iceberg_catalog: str | None = None,
             apply: bool = False, target_bytes: int | None = None,
             max_parallel: int = 1) -> DataFrame:
    """Sweep every table of each database (compaction, manifests, snapshots, orphans)."""
    if iceberg_catalog:
        backend = IcebergProcedures(spark, iceberg_catalog)
    else:
        kw = {"target_bytes": target_bytes} if target_bytes else {}
        backend = ParquetMaintenance(spark, dry_run=not apply, **kw)
    return sweep(spark, databases, backend, max_parallel=max_parallel)


def _jdbc(args) -> JdbcSource | None:
    if not args.jdbc_url:
        return None
    return JdbcSource(args.jdbc_url, args.jdbc_user, args.jdbc_password, args.jdbc_driver,
                      dialect=args.source_dialect)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lakeops.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("validate", "ingest"):
        s = sub.add_parser(name)
        s.add_argument("--control", required=True, help="control table name")
        s.add_argument("--group", type=int, required=True)
        s.add_argument("--audit", required=name == "validate",
                       help="audit table name or path (ingest: by default ingestion_audit beside the lake's tables)")
        s.add_argument("--job-name", default=name.upper())
        s.add_argument("--lake-db")
        s.add_argument("--jdbc-url")
        s.add_argument("--jdbc-user")
        s.add_argument("--jdbc-password")
        s.add_argument("--jdbc-driver")
        s.add_argument("--source-dialect", default="generic")
    sub.choices["validate"].add_argument("--mode", default="auto", choices=["auto", "joint", "per_table"])
    sub.choices["validate"].add_argument("--days", type=int, default=30,
                                         help="trailing window length in days")
    sub.choices["validate"].add_argument("--lake-upper-bound", action="store_true",
                                         help="bound the lake window by the mark as well")
    load = sub.choices["ingest"]
    load.add_argument("--lake-root")
    load.add_argument("--control-out", help="write the control table with advanced marks here "
                                            "(default: over the control table itself)")
    load.add_argument("--keep-marks", action="store_true", help="do not write the advanced marks anywhere")
    load.add_argument("--parallel", type=int, default=1)
    load.add_argument("--jdbc-partition-column", help="numeric or date column to read extracts in parallel by")
    load.add_argument("--jdbc-partitions", type=int, default=8)
    load.add_argument("--files", action="store_true",
                      help="sources are folders of dropped files (sql_query = folder, source = format); each is read once")
    load.add_argument("--checkpoints", help="where the files that were read are remembered (default: _drops beside the tables)")
    m = sub.add_parser("maintain")
    m.add_argument("--databases", nargs="+", required=True)
    m.add_argument("--iceberg-catalog")
    m.add_argument("--apply", action="store_true", help="rewrite/delete files (default: plan only)")
    m.add_argument("--target-bytes", type=int)
    m.add_argument("--parallel", type=int, default=1)
    m.add_argument("--report", help="table or path of the report (default: maintenance_report in the first database)")
    args = p.parse_args(argv)

    logging.basicConfig(level=logging.INFO)
    spark = build_session(app=f"lakeops-{args.job}")
    if args.job == "validate":
        run = validate(spark, spark.table(args.control), args.group, job_name=args.job_name,
                       audit_target=args.audit, sources=_jdbc(args),
                       lake=LakeTables(spark, database=args.lake_db), mode=args.mode,
                       days=args.days, lake_upper_bound=args.lake_upper_bound)
        log.info("audit rows of batch %s are in %s", run.batch, args.audit)
        return 0
    if args.job == "ingest":
        lake = LakeLocation(spark, root=args.lake_root, database=args.lake_db)
        src = _jdbc(args)
        sources = DropLoads(spark, lake, load_ledger(spark, lake), args.checkpoints) if args.files else JdbcRelations(
            spark, src, args.jdbc_partition_column, args.jdbc_partitions) if src else None
        audit = args.audit or (lake.path("_ingestion_audit") if args.lake_root else lake.name("ingestion_audit"))
        run, advanced = ingest(spark, spark.table(args.control), args.group, lake,
                               job_name=args.job_name, audit_target=audit,
                               sources=sources, max_parallel=args.parallel)
        if not args.keep_marks:
            save_control(advanced, args.control_out or args.control)
        log.info("%d loads succeeded, %d failed; audit rows are in %s", run.succeeded, run.failed, audit)
        return 0 if run.succeeded > 0 else 1
    report = args.report or f"{args.databases[0]}.maintenance_report"
    done = maintain(spark, args.databases, iceberg_catalog=args.iceberg_catalog, apply=args.apply,
                    target_bytes=args.target_bytes, max_parallel=args.parallel)
    append_audit(done, report)
    log.info("the report is in %s", report)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
