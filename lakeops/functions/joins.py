"""Joins in which NULL is a value like any other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Join on equality of ``cols``, NULL with NULL; the right side's ``cols`` are dropped.

    The right side's columns are renamed first, so both sides may stem from the
    same frame.
    """
    renamed = right.select(*[F.col(c).alias(f"_right_{c}") if c in cols else F.col(c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in cols])
    return left.join(renamed, same, how).drop(*[f"_right_{c}" for c in cols])
