"""Files dropped into object storage (SRC-9).

Always read with an explicit schema (no inference pass over the data) and,
by default, ``FAILFAST``: a malformed record stops the load instead of being
silently dropped or nulled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMAT_DEFAULTS = {
    "csv": {"header": "true", "mode": "FAILFAST"},
    "json": {"mode": "FAILFAST"},
    "parquet": {},
    "orc": {},
}


def reader_options(fmt: str, options: dict | None = None) -> dict[str, str]:
    if fmt not in FORMAT_DEFAULTS:
        raise ValueError(f"unsupported file format {fmt!r}")
    return {**FORMAT_DEFAULTS[fmt], **{k: str(v) for k, v in (options or {}).items()}}


def read_dropped(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str,
                 options: dict | None = None) -> DataFrame:
    """Every file under ``path`` in one format, as one DataFrame."""
    return (spark.read.schema(schema).format(fmt).options(**reader_options(fmt, options))
            .load(path))


def write_drop(df: DataFrame, path: str, fmt: str, options: dict | None = None) -> None:
    """Write files the way an upstream system would drop them (tests, fixtures)."""
    opts = {"header": "true"} if fmt == "csv" else {}
    df.write.mode("append").format(fmt).options(**{**opts, **(options or {})}).save(path)


class FileDropSources:
    """Control-row extracts that are folders of dropped files.

    ``sql_query`` holds the folder (prefix) and ``source`` the format.  Files
    are read with the target lake table's schema when that table exists (so
    a drop can never change the table's types), else with ``schema`` if
    given, else Parquet's own schema.
    """

    def __init__(self, spark: SparkSession, lake=None, schema: T.StructType | str | None = None,
                 options: dict | None = None):
        self.spark, self.lake, self.schema, self.options = spark, lake, schema, options

    def relation(self, entry, for_load: bool = False) -> tuple[str, DataFrame]:
        fmt = (entry.source or "parquet").lower()
        schema = self.schema
        if self.lake is not None and self.lake.exists(entry.tablename):
            schema = self.lake.read(entry.tablename).schema
        if schema is None:
            if fmt != "parquet":
                raise ValueError(f"{fmt} drops need a schema (target table or argument)")
            return f"files:{entry.sql_query}", self.spark.read.parquet(entry.sql_query)
        return f"files:{entry.sql_query}", read_dropped(self.spark, entry.sql_query, fmt, schema,
                                                        self.options)
