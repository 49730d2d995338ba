"""Running sums within groups that stay parallel when one group is huge.

A plain ``sum(x) over (partition by g order by o)`` sends every row of a group
to one task; with one group holding a third of the rows, that task holds a
third of the data.  Here rows are dealt by ranges of (group, order, ties)
first, so a group is cut into as many ranges as its size asks for, and rows of
equal ``o`` are told apart by the tie columns:

1. the dealt rows are written to the shared scratch folder with the number of
   their range, which fixes it whatever executor is lost later;
2. totals of each (group, range) -> offsets (a window over as many rows as a
   group has ranges);
3. running sum inside (group, range) plus the offset.

Groups are compared null-safe: NULL is a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.joins import null_safe_join
from lakeops.session import scratch_path


def grouped_running_sum(df: DataFrame, group_cols: Sequence[str], order_col: str,
                        value_col: str, out_col: str, *, tie_cols: Sequence[str] = (),
                        exclusive: bool = True, chunks: int | None = None) -> DataFrame:
    """Add ``out_col`` = sum of ``value_col`` over earlier rows of the same group.

    Rows are ordered by ``order_col`` then ``tie_cols``, NULL first; ``exclusive``
    leaves the current row out.  ``chunks``: number of ranges (default: the
    session's shuffle partitions).
    """
    spark, g = df.sparkSession, list(group_cols)
    by = [*g, order_col, *tie_cols]
    ranged = df.repartitionByRange(chunks, *by) if chunks else df.repartitionByRange(*by)
    ranged = ranged.withColumn("_chunk", F.spark_partition_id())
    path = scratch_path(spark, "ranges")
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    totals = ranged.groupBy(*g, "_chunk").agg(F.sum(value_col).alias("_chunk_sum"))
    before = Window.partitionBy(*g).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*g, "_chunk", F.coalesce(F.sum("_chunk_sum").over(before), F.lit(0)).alias("_offset"))
    w = (Window.partitionBy(*g, "_chunk").orderBy(order_col, *tie_cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = F.sum(value_col).over(w)
    if exclusive:
        local = local - F.col(value_col)
    return (null_safe_join(ranged.withColumn("_local", local), offsets, [*g, "_chunk"], "inner")
            .withColumn(out_col, F.col("_offset") + F.col("_local"))
            .drop("_chunk", "_offset", "_local"))
