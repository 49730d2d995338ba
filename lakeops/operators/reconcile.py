"""Source-vs-lake reconciliation by row counts (REC-1..REC-7, SET-1).

For every control row two counts are taken, one on the source and one on the
lake table, with predicates chosen by the load type:

=========  =====================================  ==============================
mode       source side                            lake side
=========  =====================================  ==============================
full       whole extract                          whole table
offset     ``key <= offset``                      whole table
window     ``mark - 30d < value <= mark``          ``value > mark - 30d`` (open)
=========  =====================================  ==============================

``COUNT_DIFF = SOURCE_COUNT - DATALAKE_COUNT``: positive means the lake is
missing rows.

All counts of a batch of tables form **one** Spark plan: the specs are grouped
by relation, each relation's predicates are counted in one scan (their
disjunction is pushed into it for file and row-group pruning; where a value is
compared with many marks, rows find theirs by binary search), whole-table
counts, which need file footers only, are a branch of their own, and the
per-relation rows are unioned.  A table whose plan cannot be built (missing
table or column) becomes a FAILED row without touching the others; if a batch's
job fails at run time, each of its relations is re-run on its own and only the
culprits are marked FAILED; other batches keep their counts.  A batch's audit
rows are handed on as soon as it is done, so a lost driver leaves a record.
"""

from __future__ import annotations

import datetime as dt
import time
from collections import OrderedDict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.formatting import hms, truncate_error
from lakeops.functions.predicates import (DEFAULT_WINDOW_DAYS, any_of, first_of, lake_window,
                                          loaded_up_to, source_mark, source_value, source_window,
                                          split_columns, ts_array, ts_literal)
from lakeops.operators.control import ControlEntry, LoadMode
from lakeops.sources.jdbc import JdbcSource

# Fixed value: the validation audit record, in table order; INSERT_TIMESTAMP is added on append.
AUDIT_FIELDS = [
    T.StructField("ID", T.LongType()),
    T.StructField("JOB_NAME", T.StringType()),
    T.StructField("GROUPID", T.LongType()),
    T.StructField("TABLE_NAME", T.StringType()),
    T.StructField("LOAD_TYPE", T.StringType()),
    T.StructField("INCREMENTAL_COLUMN", T.StringType()),
    T.StructField("SOURCE_COUNT", T.LongType()),
    T.StructField("DATALAKE_COUNT", T.LongType()),
    T.StructField("COUNT_DIFF", T.LongType()),
    T.StructField("STARTDATETIME", T.TimestampNTZType()),
    T.StructField("START_OFFSET", T.LongType()),
    T.StructField("STATUS", T.StringType()),
    T.StructField("ERROR_MESSAGE", T.StringType()),
    T.StructField("SRC_QUERY_EXEC_TIME", T.StringType()),
    T.StructField("TARGET_QUERY_EXEC_TIME", T.StringType()),
    T.StructField("BATCH_NUMBER", T.StringType()),
]
AUDIT_SCHEMA = T.StructType(AUDIT_FIELDS)
AUDIT_COLUMNS = [f.name for f in AUDIT_FIELDS]

SOURCE, LAKE = "source", "lake"
# Marks of one column on one relation from which rows are counted by searching the sorted marks,
# instead of by one predicate for each mark.
SEARCHED_MARKS = 16
# Tables of one joint job.
BATCH_TABLES = 32


@dataclass
class Bounds:
    """``low < value <= high``: what every predicate of a reconciliation is; an end that is None is open."""

    key: tuple                       # specs of one relation and key have the same value expression
    value: Callable[[], Column]
    low: object = None
    high: object = None

    def literal(self, mark) -> Column:
        return ts_literal(mark) if isinstance(mark, dt.datetime) else F.lit(mark)


@dataclass
class CountSpec:
    """One count to take: ``count(*) where predicate`` on a relation."""

    slot: int            # position of the entry in the plan (control ids need not be unique)
    side: str
    relation_key: str
    frame: DataFrame
    predicate: Callable[[], Column] | None = None
    bounds: Bounds | None = None   # of the predicate
    precounted: bool = False  # frame already is one row with column CNT


@dataclass
class ReconcilePlan:
    entries: list[ControlEntry]                 # kept entries; a spec's slot indexes this list
    specs: list[CountSpec]
    failed: dict[int, str]                      # planning failures by slot
    skipped: list[ControlEntry] = field(default_factory=list)   # unknown load type


def _source_spec(spark, slot: int, entry: ControlEntry, sources, days: int, resolve) -> CountSpec:
    mode = entry.mode
    if isinstance(sources, JdbcSource):
        frame = sources.entry_count_frame(spark, entry, days)
        return CountSpec(slot, SOURCE, f"jdbc:{slot}", frame, precounted=True)
    key, frame = resolve(("source", entry.base_query or entry.sql_query, entry.tablename),
                         lambda: sources.relation(entry))
    pred = bounds = None
    if mode is LoadMode.OFFSET:
        (col,) = split_columns(entry.data_validation_column)
        pred = lambda: loaded_up_to(col, entry.offset_value)
        bounds = Bounds(("offset", col), lambda: F.col(col), None, entry.offset_value)
    elif mode is LoadMode.WINDOW:
        if entry.startdatetime is None:
            raise ValueError("time-window reconciliation needs startdatetime")
        cols, mark = split_columns(entry.data_validation_column), entry.startdatetime
        pred = lambda: source_window(cols, ts_literal(mark), entry.dialect, days)
        high = source_mark(mark, entry.dialect)
        bounds = Bounds((entry.dialect, *cols), lambda: source_value(cols, entry.dialect),
                        high - dt.timedelta(days=days), high)
    return CountSpec(slot, SOURCE, key, frame, pred, bounds)


def _lake_spec(slot: int, entry: ControlEntry, lake, days: int, upper_bound: bool,
               resolve) -> CountSpec:
    key, frame = resolve(("lake", entry.tablename), lambda: lake.relation(entry.tablename))
    pred = bounds = None
    if entry.mode is LoadMode.WINDOW:
        if entry.startdatetime is None:
            raise ValueError("time-window reconciliation needs startdatetime")
        cols, mark = split_columns(entry.data_validation_column), entry.startdatetime.replace(tzinfo=None)
        pred = lambda: lake_window(cols, ts_literal(mark), days, upper_bound)
        bounds = Bounds(("lake", *cols), lambda: first_of([F.col(c) for c in cols]),
                        mark - dt.timedelta(days=days), mark if upper_bound else None)
    return CountSpec(slot, LAKE, key, frame, pred, bounds)


def _check_predicates(specs: list[CountSpec], failed: dict[int, str]) -> None:
    """Resolve the predicates now, so a bad column fails its own tables at planning time.

    Predicates on the same value differ in their marks only: one of each is enough, all of a
    relation in one ``select``; only when that fails are they checked one by one.
    """
    for group in _groups([s for s in specs if s.predicate is not None]).values():
        by_value: dict[tuple, list[CountSpec]] = {}
        for s in group:
            by_value.setdefault(s.bounds.key, []).append(s)
        try:
            group[0].frame.select(*[same[0].predicate() for same in by_value.values()])
            continue
        except Exception:  # noqa: BLE001 - narrowed below
            pass
        for same in by_value.values():
            try:
                same[0].frame.select(same[0].predicate())
            except Exception as exc:  # noqa: BLE001 - recorded in the audit row
                for s in same:
                    failed.setdefault(s.slot, truncate_error(exc))


def plan_reconcile(spark: SparkSession, entries: list[ControlEntry], sources, lake,
                   days: int = DEFAULT_WINDOW_DAYS, lake_upper_bound: bool = False) -> ReconcilePlan:
    """Resolve both counts of every entry; no job runs here.

    Entries naming the same relation share one resolved DataFrame, which is
    what lets :func:`counts_frame` scan it once.
    """
    specs, failed, skipped, kept = [], {}, [], []
    cache: dict = {}

    def resolve(key, make):
        if key not in cache:
            cache[key] = make()
        return cache[key]

    for e in entries:
        if e.mode is None:
            skipped.append(e)
            continue
        slot = len(kept)
        kept.append(e)
        try:
            specs += [_source_spec(spark, slot, e, sources, days, resolve),
                      _lake_spec(slot, e, lake, days, lake_upper_bound, resolve)]
        except Exception as exc:  # noqa: BLE001 - recorded in the audit row
            failed[slot] = truncate_error(exc)
    _check_predicates(specs, failed)
    return ReconcilePlan(kept, [s for s in specs if s.slot not in failed], failed, skipped)


def _relation_counts(specs: list[CountSpec]) -> DataFrame:
    """The counts of all specs that share a relation: ``(SLOT, SIDE, CNT)`` rows.

    Slots without a matching row may be left out: their count is 0.
    """
    first = specs[0]
    if first.precounted:
        return first.frame.select(F.lit(first.slot).alias("SLOT"),
                                  F.lit(first.side).alias("SIDE"), F.col("CNT"))
    whole = [s for s in specs if s.predicate is None]
    some = [s for s in specs if s.predicate is not None]
    parts = []
    if whole:  # answered from file footers; a predicate beside it would make it read columns
        marks = F.array(*[F.struct(F.lit(s.slot).alias("SLOT"), F.lit(s.side).alias("SIDE")) for s in whole])
        parts.append(first.frame.agg(F.count(F.lit(1)).alias("CNT")).select(F.inline(marks), "CNT"))
    by_value: dict[tuple, list[CountSpec]] = {}
    for s in some:
        by_value.setdefault(s.bounds.key, []).append(s)
    searched = [same for same in by_value.values() if len(same) >= SEARCHED_MARKS]
    parts += [_searched_counts(same) for same in searched]
    few = [s for same in by_value.values() if len(same) < SEARCHED_MARKS for s in same]
    for i in range(0, len(few), _WIDE):
        wide = few[i:i + _WIDE]
        preds = [s.predicate() for s in wide]
        aggs = [F.count_if(p).alias(f"c{i}") for i, p in enumerate(preds)]
        # One expression unpivots the counts (SLOT, SIDE, CNT); sides are fixed words.
        cells = ", ".join(f"{s.slot}, '{s.side}', c{i}" for i, s in enumerate(wide))
        parts.append(first.frame.where(any_of(preds)).agg(*aggs)  # pushed to the scan
                     .selectExpr(f"stack({len(wide)}, {cells}) AS (SLOT, SIDE, CNT)"))
    return reduce(lambda a, b: a.unionByName(b), parts)


# Counts of different columns beside each other in one aggregate: a wider one leaves whole-stage
# code generation (``spark.sql.codegen.maxFields``).
_WIDE = 64


def _searched_counts(specs: list[CountSpec]) -> DataFrame:
    """Counts of many marks on one value, in one scan and one binary search a row.

    The marks are sorted; a row's bucket is the number of marks below its value.  Rows are
    counted by bucket, and sums up to a bucket answer ``value <= mark`` for every mark, so each
    count is a difference of two of them.  What grows with the marks is the search (by the
    logarithm) and the frames of one row a mark.
    """
    bounds = [s.bounds for s in specs]
    marks = sorted({m for b in bounds for m in (b.low, b.high) if m is not None})
    place = {m: i for i, m in enumerate(marks)}
    spark, value = specs[0].frame.sparkSession, bounds[0].value()
    literals = ts_array(marks) if isinstance(marks[0], dt.datetime) else F.array(*[F.lit(m) for m in marks])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(marks).bit_length()))])
    frame = specs[0].frame
    if all(b.low is not None for b in bounds):
        frame = frame.where(value > bounds[0].literal(min(b.low for b in bounds)))
    if all(b.high is not None for b in bounds):
        frame = frame.where(value <= bounds[0].literal(max(b.high for b in bounds)))
    # The value is bound to a name, so that the search does not compute it anew at every step.
    bucket = F.transform(F.array(value), lambda v: F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.try_element_at(literals, at + step) < v, at + step).otherwise(at)))[0]
    histogram = frame.where(value.isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    every = spark.range(len(marks) + 1).select(F.col("id").cast("int").alias("bucket"))
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)  # one row a mark
    sums = (every.join(histogram, "bucket", "left")
            .select("bucket", F.sum(F.coalesce("n", F.lit(0))).over(upto).alias("upto")))
    ends = []
    for s in specs:
        ends.append((s.slot, s.side, len(marks) if s.bounds.high is None else place[s.bounds.high], 1))
        if s.bounds.low is not None:
            ends.append((s.slot, s.side, place[s.bounds.low], -1))
    ends = spark.createDataFrame(ends, "SLOT int, SIDE string, bucket int, sign int")
    return (ends.join(sums, "bucket").groupBy("SLOT", "SIDE")
            .agg(F.sum(F.col("sign") * F.col("upto")).alias("CNT")))


def _groups(specs: list[CountSpec]) -> "OrderedDict[str, list[CountSpec]]":
    """Specs by relation."""
    groups: OrderedDict[str, list[CountSpec]] = OrderedDict()
    for s in specs:
        groups.setdefault(s.relation_key, []).append(s)
    return groups


def _batches(specs: list[CountSpec]) -> list[list[CountSpec]]:
    """Specs in batches of about ``BATCH_TABLES`` tables; tables that share a relation stay together."""
    by_slot: dict[int, list[CountSpec]] = {}
    for s in specs:
        by_slot.setdefault(s.slot, []).append(s)
    head = {slot: slot for slot in by_slot}  # tables bound together through a relation have one head

    def head_of(slot: int) -> int:
        while head[slot] != slot:
            head[slot] = slot = head[head[slot]]
        return slot

    first: dict[str, int] = {}
    for s in specs:
        a, b = head_of(s.slot), head_of(first.setdefault(s.relation_key, s.slot))
        head[max(a, b)] = min(a, b)
    bound: dict[int, list[int]] = {}
    for slot in by_slot:
        bound.setdefault(head_of(slot), []).append(slot)
    out: list[list[CountSpec]] = []
    tables = BATCH_TABLES
    for group in bound.values():
        if tables + len(group) > BATCH_TABLES:
            out.append([])
            tables = 0
        tables += len(group)
        out[-1] += [s for x in group for s in by_slot[x]]
    return out


def counts_frame(specs: list[CountSpec]) -> DataFrame:
    """All counts of a batch as one plan: union of one aggregate per relation."""
    parts = [_relation_counts(g) for g in _groups(specs).values()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _meta_row(e: ControlEntry, job_name: str, batch: str) -> dict:
    return {"ID": e.id, "JOB_NAME": job_name, "GROUPID": e.groupid, "TABLE_NAME": e.tablename,
            "LOAD_TYPE": e.loadtype, "INCREMENTAL_COLUMN": e.data_validation_column,
            "STARTDATETIME": e.startdatetime, "START_OFFSET": e.offset_value,
            "BATCH_NUMBER": batch}


def _audit_row(e, job_name, batch, src=None, lake=None, error=None,
               src_time=None, lake_time=None) -> tuple:
    row = _meta_row(e, job_name, batch)
    ok = error is None
    row.update({"SOURCE_COUNT": src if ok else None, "DATALAKE_COUNT": lake if ok else None,
                "COUNT_DIFF": (src - lake) if ok else None,
                "STATUS": "SUCCESS" if ok else "FAILED",
                "ERROR_MESSAGE": None if ok else truncate_error(error),
                "SRC_QUERY_EXEC_TIME": src_time if ok else None,
                "TARGET_QUERY_EXEC_TIME": lake_time if ok else None})
    return tuple(row[c] for c in AUDIT_COLUMNS)


def reconcile_frame(spark: SparkSession, plan: ReconcilePlan, job_name: str,
                    batch: str) -> DataFrame:
    """Lazy audit rows of a plan: counts joined to the control metadata.

    The metadata frame holds one row per control entry (built from the
    collected control rows), so its size is bounded by the control group.
    """
    ok_slots = [i for i in range(len(plan.entries)) if i not in plan.failed]
    failed_rows = [_audit_row(plan.entries[i], job_name, batch, error=msg)
                   for i, msg in sorted(plan.failed.items())]
    frames = []
    if ok_slots:
        counts = counts_frame(plan.specs).groupBy("SLOT").agg(
            F.coalesce(F.max(F.when(F.col("SIDE") == SOURCE, F.col("CNT"))), F.lit(0)).alias("SOURCE_COUNT"),
            F.coalesce(F.max(F.when(F.col("SIDE") == LAKE, F.col("CNT"))), F.lit(0)).alias("DATALAKE_COUNT"))
        meta_schema = T.StructType([f for f in AUDIT_FIELDS if f.name in (
            "ID", "JOB_NAME", "GROUPID", "TABLE_NAME", "LOAD_TYPE", "INCREMENTAL_COLUMN",
            "STARTDATETIME", "START_OFFSET", "BATCH_NUMBER")])
        meta = spark.createDataFrame(
            [(i, *(_meta_row(plan.entries[i], job_name, batch)[f.name] for f in meta_schema))
             for i in ok_slots],
            T.StructType([T.StructField("SLOT", T.IntegerType()), *meta_schema.fields]))
        computed = {
            "COUNT_DIFF": F.col("SOURCE_COUNT") - F.col("DATALAKE_COUNT"),
            "STATUS": F.lit("SUCCESS"),
            "ERROR_MESSAGE": F.lit(None).cast("string"),
            "SRC_QUERY_EXEC_TIME": F.lit(None).cast("string"),
            "TARGET_QUERY_EXEC_TIME": F.lit(None).cast("string"),
        }
        ok = meta.join(counts, "SLOT", "left").fillna(0, ["SOURCE_COUNT", "DATALAKE_COUNT"]).select(
            *[computed[c].alias(c) if c in computed else F.col(c) for c in AUDIT_COLUMNS])
        frames.append(ok)
    if failed_rows or not frames:
        frames.append(spark.createDataFrame(failed_rows, AUDIT_SCHEMA))
    return reduce(lambda a, b: a.unionByName(b), frames)


@dataclass
class ReconcileResult:
    audit: DataFrame
    skipped: list[ControlEntry]
    mode: str


def _run_group(specs: list[CountSpec]) -> tuple[dict, float]:
    t0 = time.monotonic()
    rows = _relation_counts(specs).collect()
    return {(r["SLOT"], r["SIDE"]): r["CNT"] for r in rows}, time.monotonic() - t0


def run_reconcile(spark: SparkSession, entries: list[ControlEntry], sources, lake, *,
                  job_name: str, batch: str, days: int = DEFAULT_WINDOW_DAYS,
                  lake_upper_bound: bool = False, mode: str = "joint",
                  max_parallel: int = 4,
                  on_rows: Callable[[DataFrame], None] | None = None) -> ReconcileResult:
    """Reconcile a batch and return its audit rows (REC-7).

    ``mode="joint"``: one job for all counts of up to ``BATCH_TABLES`` tables, which
    share its elapsed time.  ``mode="per_table"``: one job per relation, up to
    ``max_parallel`` at a time, each with its own time.  A failed joint job falls
    back to per-table so a single bad table cannot hide the others' results.
    ``mode="auto"`` takes the cheaper of the two for each batch: a joint job where relations
    are shared by several counts (they are scanned once anyway, and one plan costs less than
    many), else concurrent jobs, whose small plans neither wait for each other nor meet in a
    shuffle.  Jobs of a batch run in scheduler pools of their own, so under FAIR scheduling a
    large relation does not hold up the small ones.
    JDBC sources always run per table: their counts execute in the source
    database, and ``max_parallel`` bounds how many it receives at once.

    ``on_rows`` gets the audit rows of each batch as soon as it is done (those
    that failed in planning first).
    """
    if isinstance(sources, JdbcSource):
        mode = "per_table"
    plan = plan_reconcile(spark, entries, sources, lake, days, lake_upper_bound)
    rows: list[tuple] = []
    ran = "per_table" if mode == "auto" else mode

    def told(slots, counts, times, errors) -> None:
        new = []
        for i in slots:
            e = plan.entries[i]
            if i in errors:
                new.append(_audit_row(e, job_name, batch, error=errors[i]))
            else:
                new.append(_audit_row(e, job_name, batch, counts.get((i, SOURCE), 0), counts.get((i, LAKE), 0),
                                      None, times.get((i, SOURCE)), times.get((i, LAKE))))
        rows.extend(new)
        if on_rows and new:
            on_rows(spark.createDataFrame(new, AUDIT_SCHEMA))

    told(sorted(plan.failed), {}, {}, plan.failed)
    for specs in _batches([s for s in plan.specs if s.slot not in plan.failed]):
        counts, times, errors = None, {}, {}
        if (cheaper_mode(specs) if mode == "auto" else mode) == "joint":
            ran = "joint"
            t0 = time.monotonic()
            try:
                counts = {(r["SLOT"], r["SIDE"]): r["CNT"] for r in counts_frame(specs).collect()}
                times = {(s.slot, s.side): hms(time.monotonic() - t0) for s in specs}
            except Exception:  # noqa: BLE001 - isolate the failing relation below
                ran = "per_table"
        if counts is None:
            counts, times, errors = _one_by_one(specs, max_parallel)
        told(sorted({s.slot for s in specs}), counts, times, errors)
    # SET-1: successes first, then failures.
    rows.sort(key=lambda r: r[AUDIT_COLUMNS.index("STATUS")] != "SUCCESS")
    return ReconcileResult(spark.createDataFrame(rows, AUDIT_SCHEMA), plan.skipped, ran)


def cheaper_mode(specs: list[CountSpec]) -> str:
    """``joint`` if relations are shared by at least two counts on average, else ``per_table``."""
    return "joint" if len(specs) >= 2 * len(_groups(specs)) else "per_table"


def _one_by_one(specs: list[CountSpec], max_parallel: int) -> tuple[dict, dict, dict]:
    """One job per relation: counts, elapsed times and errors."""
    counts: dict = {}
    times: dict = {}
    errors: dict[int, str] = {}

    def one(g):
        try:
            # Pinned threads: the pool holds for the jobs of this thread only.
            g[0].frame.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", f"reconcile-{g[0].slot % max_parallel}")
            return g, _run_group(g), None
        except Exception as exc:  # noqa: BLE001 - recorded in the audit row
            return g, None, exc

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        for g, res, exc in pool.map(one, _groups(specs).values()):
            if exc is not None:
                for s in g:
                    errors.setdefault(s.slot, truncate_error(exc))
                continue
            counts.update(res[0])
            for s in g:
                times[(s.slot, s.side)] = hms(res[1])
    return counts, times, errors
