"""Relations read through Spark: lake tables and Spark-readable sources (SRC-4).

A relation is resolved to a ``DataFrame`` eagerly, so a missing table or
column fails at analysis time, before any job runs, and can be reported for
that table alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeops.operators.control import ControlEntry


@dataclass
class LakeTables:
    """Lake tables by name, optionally qualified by catalog and database."""

    spark: SparkSession
    database: str | None = None
    catalog: str | None = None

    def qualified(self, name: str) -> str:
        parts = [p for p in (self.catalog, self.database) if p] + [name]
        return ".".join(parts)

    def relation(self, name: str) -> tuple[str, DataFrame]:
        q = self.qualified(name)
        return f"table:{q}", self.spark.table(q)


# How control rows write the two high-water marks into an extract.
OFFSET_SLOT, TIME_SLOT = "{offset_value}", "{startdatetime}"


def has_mark_slot(text: str | None) -> bool:
    return bool(text) and (OFFSET_SLOT in text or TIME_SLOT in text)


@dataclass
class SparkSources:
    """Source relations defined by the control row's ``sql_query``, run by Spark.

    An extract may hold the row's marks as ``{offset_value}`` and
    ``{startdatetime}``; a load binds them as typed arguments of the statement.
    Reconciliation adds its own typed predicate to a base extract with ``where``, so
    it needs one without marks: the row's ``base_query``, or a ``sql_query`` that
    holds none.  With neither, ``tablename`` is read.
    """

    spark: SparkSession

    def relation(self, entry: ControlEntry, for_load: bool = False) -> tuple[str, DataFrame]:
        text = entry.sql_query if for_load else entry.base_query or entry.sql_query
        if not text:
            return f"table:{entry.tablename}", self.spark.table(entry.tablename)
        text = " ".join(text.split()).rstrip(";")
        if not has_mark_slot(text):
            return f"sql:{text}", self.spark.sql(text)
        if not for_load:
            raise ValueError(f"the extract of {entry.tablename} holds a mark placeholder: reconciliation needs "
                             "the control row's base_query, the extract without its incremental predicate")
        marks = {"offset_value": (OFFSET_SLOT, entry.offset_value), "startdatetime": (TIME_SLOT, entry.startdatetime)}
        bound = {}
        for name, (slot, value) in marks.items():
            if slot in text:
                if value is None:
                    raise ValueError(f"the extract of {entry.tablename} needs {name}, which is NULL")
                typed = f"CAST(:{name} AS TIMESTAMP_NTZ)" if name == "startdatetime" else f":{name}"
                text = text.replace(f"'{slot}'", slot).replace(slot, typed)
                bound[name] = str(value) if name == "startdatetime" else value
        return f"sql:{text}:{sorted(map(str, bound.items()))}", self.spark.sql(text, args=bound)
