"""Typed row predicates of the reconciliation and ingestion jobs.

The incremental extract of a table selects rows past a high-water mark
(``pending``).  Reconciliation inverts that predicate to count what should
already be in the lake: either up to a numeric offset, or inside a trailing
window that ends at the time mark.  All timestamps are ``TIMESTAMP_NTZ`` and
every bound is computed with NTZ arithmetic, so no result depends on the
session time zone.  Every function returns a ``Column``; callers put it in a
``where`` so Catalyst pushes it into the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_WINDOW_DAYS = 30


def ts_literal(value: dt.datetime | dt.date | str) -> Column:
    """A ``TIMESTAMP_NTZ`` literal with microsecond precision (SCL-4).

    The value is rendered in ISO form and cast, which is exact and
    independent of both the Python process and the session time zone.
    """
    if isinstance(value, dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ", timespec="microseconds")
    elif isinstance(value, dt.date):
        text = f"{value.isoformat()} 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def ts_array(values: Sequence[dt.datetime]) -> Column:
    """An array of ``TIMESTAMP_NTZ`` literals, parsed as one expression however many there are."""
    return F.expr("array(" + ", ".join(
        f"TIMESTAMP_NTZ '{v.replace(tzinfo=None).isoformat(sep=' ', timespec='microseconds')}'" for v in values) + ")")


def days_before(mark: Column, days: int = DEFAULT_WINDOW_DAYS) -> Column:
    """``mark - INTERVAL days DAY`` (SCL-5)."""
    return mark - F.make_dt_interval(F.lit(days))


def split_columns(spec: str | Sequence[str]) -> list[str]:
    """A comma list of column names, each trimmed (SCL-1)."""
    if spec is None:
        raise ValueError("no validation column given")
    if isinstance(spec, str):
        parts = spec.split(",")
    else:
        parts = list(spec)
    cols = [p.strip() for p in parts if p and p.strip()]
    if not cols:
        raise ValueError("no validation column given")
    return cols


def first_of(cols: Sequence[Column]) -> Column:
    """First non-null of several columns; a single column stays bare (SCL-2)."""
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)


def round_to_millis(ts: Column) -> Column:
    """Round a ``TIMESTAMP_NTZ`` to whole milliseconds, half up (SCL-3).

    This is the precision of a ``datetime2(3)`` conversion on the source.
    The sub-millisecond part is read from the seconds field and removed with
    NTZ interval arithmetic, which never consults the session time zone
    (epoch-based helpers do, and shift wall-clock times inside a DST gap).
    """
    sub = (F.date_part(F.lit("SECOND"), ts) * 1000000).cast("long") % 1000
    one_us = F.make_dt_interval(secs=F.lit(0.000001).cast("decimal(18,6)"))
    down = ts - one_us * sub
    return F.when(sub >= 500, down + one_us * 1000).otherwise(down)


def try_timestamp_millis(c: Column) -> Column:
    """Null-on-failure conversion to a millisecond timestamp (SCL-3)."""
    return round_to_millis(c.try_cast("timestamp_ntz"))


def bounded_window(value: Column, mark: Column,
                   days: int = DEFAULT_WINDOW_DAYS) -> Column:
    """``mark - days < value <= mark``: exclusive low, inclusive high."""
    return (value > days_before(mark, days)) & (value <= mark)


def source_window(cols: Sequence[str], mark: Column, dialect: str,
                  days: int = DEFAULT_WINDOW_DAYS) -> Column:
    """The bounded trailing window applied on the source side.

    ``oracle`` (FLT-2): the column(s) as stored, microsecond precision.
    any other source (FLT-3): every column goes through a null-on-failure
    conversion to a millisecond timestamp, the first that converts wins, and
    the mark is rounded the same way.
    """
    value = source_value(cols, dialect)
    return bounded_window(value, mark if dialect == "oracle" else round_to_millis(mark), days)


def source_value(cols: Sequence[str], dialect: str) -> Column:
    """What a source window compares: the columns as stored, or as millisecond timestamps."""
    if dialect == "oracle":
        return first_of([F.col(c) for c in cols])
    return first_of([try_timestamp_millis(F.col(c)) for c in cols])


def source_mark(mark: dt.datetime, dialect: str) -> dt.datetime:
    """The mark that a source window ends at: rounded half up to milliseconds, but for ``oracle``."""
    mark = mark.replace(tzinfo=None)
    if dialect == "oracle":
        return mark
    below = mark.microsecond % 1000
    return mark + dt.timedelta(microseconds=(1000 if below >= 500 else 0) - below)


def lake_window(cols: Sequence[str], mark: Column, days: int = DEFAULT_WINDOW_DAYS,
                upper_bound: bool = False) -> Column:
    """The trailing window on the lake side (FLT-4).

    By default it is open above (``value > mark - days``), so rows landed after
    the mark are counted on this side only; ``upper_bound=True`` gives the
    symmetric check.
    """
    columns = [F.col(c) for c in cols]
    low = days_before(mark, days)

    def inside(value: Column) -> Column:
        return bounded_window(value, mark, days) if upper_bound else value > low

    if len(columns) == 1:
        return inside(columns[0])
    # COALESCE cannot be pushed into a scan; that one of the columns is inside follows from it and can.
    return inside(first_of(columns)) & any_of([inside(c) for c in columns])


def loaded_up_to(key: str, offset: int | Column) -> Column:
    """Rows already loaded by a numeric high-water mark: ``key <= offset`` (FLT-5)."""
    return F.col(key) <= (offset if isinstance(offset, Column) else F.lit(offset))


def pending(key: str | Sequence[str], mark) -> Column:
    """Rows past the high-water mark, the incremental extract (FLT-6).

    Of several key columns the first that is not null counts; that any of them
    is past the mark follows from it, and is said besides because a scan can
    prune by it.
    """
    if isinstance(mark, Column):
        bound = mark
    elif isinstance(mark, (dt.datetime, dt.date)):
        bound = ts_literal(mark)
    else:
        bound = F.lit(mark)
    cols = [F.col(key)] if isinstance(key, str) else [F.col(k) for k in key]
    if len(cols) == 1:
        return cols[0] > bound
    return (first_of(cols) > bound) & any_of([c > bound for c in cols])


def any_of(preds: Sequence[Column]) -> Column:
    """OR of the predicates as a balanced tree (depth log n, not n)."""
    preds = list(preds)
    while len(preds) > 1:
        preds = [preds[i] | preds[i + 1] if i + 1 < len(preds) else preds[i]
                 for i in range(0, len(preds), 2)]
    return preds[0]
