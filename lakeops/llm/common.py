"""Helpers shared by the operators: cut lineage, running sums, ranks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.session import scratch_path

# Words of the operators that split at ASCII white space (fixed value).
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The written table cuts lineage: a lost executor costs a re-read, not a
    recomputation, and what follows plans on the measured size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_names(rows: DataFrame) -> DataFrame:
    """``(id, sha, bytes, n_words)`` of each of ``rows(id, text)``, written once, as several steps read it."""

    @F.pandas_udf("int")
    def count_words(data: pd.Series) -> pd.Series:
        return pd.Series([len(x.split()) for x in data], dtype="int32")  # at ASCII white space, as SPACE_WORD

    return materialise(rows.select("id", F.sha2("text", 256).alias("sha"), F.octet_length("text").alias("bytes"),
                                   count_words(F.col("text").cast("binary")).alias("n_words")), "text-names")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def chunked_running(df: DataFrame, keys: list[str], chunk: str, order: list[str], value: str,
                    out: str) -> DataFrame:
    """Sum of ``value`` over the rows before this one in its group, as ``out``.

    Rows of a group are ordered by (``chunk``, ``order``); ``chunk`` must grow
    with that order and holds a bounded share of rows, so no task ever sorts a
    whole group: sums per chunk are added up first, then each chunk runs on its
    own.  ``keys`` and ``chunk`` must not be null.
    """
    by = [*keys, chunk]
    sums = df.groupBy(*by).agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*by, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(offsets, by)
            .withColumn(out, F.col("__before") + F.col("__inside"))
            .drop("__before", "__inside"))
