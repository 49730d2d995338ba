"""Lakehouse operations on Spark: source-vs-lake reconciliation, control-table
driven ingestion and table maintenance, all as DataFrame plans.

Main entry points::

    from lakeops import (build_session, control_scan, to_entries, run_reconcile,
                         run_ingestion, compaction_plan, rewrite_bins, sweep)
"""

__version__ = "0.1.0"

from lakeops.operators.audit import append_audit  # noqa: E402
from lakeops.operators.control import ControlEntry, control_scan, ingestion_scan, to_entries  # noqa: E402
from lakeops.operators.ingest import (LakeLocation, load_full, load_incremental,  # noqa: E402
                                      load_merge, overwrite_partitions, run_ingestion)
from lakeops.operators.maintenance import (compaction_plan, expired_snapshots,  # noqa: E402
                                           orphan_files, rewrite_bins, sweep)
from lakeops.operators.reconcile import plan_reconcile, reconcile_frame, run_reconcile  # noqa: E402
from lakeops.session import build_session, scratch_path  # noqa: E402

__all__ = [
    "ControlEntry", "LakeLocation", "append_audit", "build_session", "compaction_plan",
    "control_scan", "expired_snapshots", "ingestion_scan", "load_full", "load_incremental",
    "load_merge", "orphan_files", "overwrite_partitions", "plan_reconcile", "reconcile_frame",
    "rewrite_bins", "run_ingestion", "run_reconcile", "scratch_path", "sweep", "to_entries",
]
