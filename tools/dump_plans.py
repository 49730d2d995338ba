"""Write the final (post-AQE) physical plans of the headline queries to PLANS.md.

    python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lakeops.functions.predicates import pending  # noqa: E402
from lakeops.operators.ingest import latest_per_key, load_full, merged_rows  # noqa: E402
from lakeops.operators.reconcile import counts_frame, plan_reconcile  # noqa: E402
from lakeops.plans import catalogue as cat  # noqa: E402
from lakeops.plans import fixtures as fx  # noqa: E402
from lakeops.session import build_session  # noqa: E402
from lakeops.sources.lake import LakeTables, SparkSources  # noqa: E402

NOTES = {
    "reconcile_many_marks (counts)": (
        "24 counts, one scan per relation; the OR of the windows is pushed into each Parquet "
        "scan. At 1000x: same shape. Each scan is a map-only stage with a partial count per "
        "task, and the single-partition exchange carries one row per task; time windows prune "
        "row groups (and partitions on date-partitioned lakes), so cost follows the window, not "
        "the table."),
    "load_merge (merged rows)": (
        "Target scan pruned to the touched years by dynamic partition pruning; updates "
        "deduplicated by a partial aggregate. At 1000x: the broadcasts seen here are AQE "
        "decisions from measured sizes; bigger update sets get sort-merge anti/semi joins "
        "(AQE splits a skewed key's partition); untouched partitions are neither read nor "
        "rewritten."),
    "compaction_plan": (
        "The files were dealt by ranges of (partition, order, ties) and written with the number of "
        "their range before this plan; here: totals per (partition, range), offsets by a window "
        "over the ranges of a partition, running sums within. At 1000x: a table partition with a "
        "third of all files is cut into a third of the ranges."),
    "snapshot_expiry": (
        "row_number() <= k runs as a partial WindowGroupLimit before the shuffle. At 1000x: a "
        "table with a third of all snapshots ships k rows per map task to the final limit; the "
        "keep-from join has one row per table on the build side."),
    "orphan_files": (
        "Anti-join; AQE picks broadcast or sort-merge from the measured size. At 1000x: a "
        "sort-merge anti-join on unique file paths, so no skew."),
}


def final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own execution, which finalizes its adaptive plan
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)
    return "\n".join(line if len(line) <= 160 else line[:157] + "..."
                     for line in text.splitlines())


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "16",
                                            "spark.sql.session.timeZone": "UTC"})
    fx.register(spark, sf)
    frames = {}
    plan = plan_reconcile(spark, cat.many_marks_entries(), SparkSources(spark), LakeTables(spark))
    frames["reconcile_many_marks (counts)"] = counts_frame(plan.specs)
    lake = cat._lake(spark)
    load_full(cat._with_year(spark.table("orders_lake")), lake, "orders", ["o_year"])
    upd = latest_per_key(cat._with_year(spark.sql(cat.ORDERS_UPD_SQL))
                         .where(pending("o_orderdate", dt.datetime(2001, 6, 1))), ["o_orderkey"])
    frames["load_merge (merged rows)"] = merged_rows(lake.read("orders"), upd, ["o_orderkey"],
                                                     ["o_year"])
    for name in ("compaction_plan", "snapshot_expiry", "orphan_files"):
        frames[name] = cat.QUERIES[name](spark, sf)
    out = [f"# Physical plans (final, after AQE) at {os.path.basename(sf)}\n",
           "Generated by `tools/dump_plans.py`; expression ids removed, long lines cut.\n"]
    for name, df in frames.items():
        out += [f"## {name}\n", NOTES.get(name, "") + "\n", "```", final_plan(df), "```\n"]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
