"""Relational sources over JDBC (SRC-1, SRC-2, SRC-3, SRC-8).

A count is computed in the database: the extract query is wrapped in
``SELECT COUNT(*) AS CNT FROM (...)`` with the reconciliation predicate
rendered in the source's dialect, and Spark reads the single row back.  The
predicate text is generated from typed values (validated identifiers,
formatted timestamps, integers), never spliced from free text.

Bulk extracts are split into parallel range reads of equally many rows on a numeric or
date column.
"""

from __future__ import annotations

import datetime as dt
import decimal
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.predicates import DEFAULT_WINDOW_DAYS, split_columns
from lakeops.operators.control import ControlEntry, LoadMode
from lakeops.sources.lake import OFFSET_SLOT, TIME_SLOT, has_mark_slot

# JDBC fetch sizes of the two source kinds.
ORACLE_FETCH_SIZE = 100000
GENERIC_FETCH_SIZE = 1000000
# Rows per round trip of a bulk extract: the sizes above are meant for counts of one row.
EXTRACT_FETCH_SIZE = 10000
# Fixed value: the Oracle degree-of-parallelism hint on incremental counts.
ORACLE_PARALLEL_HINT = "/*+ PARALLEL(5) */"

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_$#]*$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain column name: {name!r}")
    return name


def _ts_text(value: dt.datetime) -> str:
    return value.replace(tzinfo=None).isoformat(sep=" ", timespec="microseconds")


def window_predicate_sql(dialect: str, columns: str, mark: dt.datetime,
                         days: int = DEFAULT_WINDOW_DAYS, alias: str = "extract_rows") -> str:
    """``mark - days < value <= mark`` in the source's SQL dialect."""
    cols = [f"{alias}.{_ident(c)}" for c in split_columns(columns)]
    stamp = _ts_text(mark)
    if dialect == "oracle":
        value = cols[0] if len(cols) == 1 else f"COALESCE({', '.join(cols)})"
        hi = f"TO_TIMESTAMP('{stamp}', 'YYYY-MM-DD HH24:MI:SS.FF')"
        return f"{value} > {hi} - INTERVAL '{int(days)}' DAY AND {value} <= {hi}"
    conv = [f"TRY_CONVERT(datetime2(3), {c})" for c in cols]
    value = conv[0] if len(conv) == 1 else f"COALESCE({', '.join(conv)})"
    # All digits, converted in two steps: the database rounds to milliseconds, as it does the values.
    hi = f"CAST(CAST('{stamp}' AS datetime2(6)) AS datetime2(3))"
    return f"{value} > DATEADD(DAY, -{int(days)}, {hi}) AND {value} <= {hi}"


def bound_marks(entry: ControlEntry) -> str:
    """A row's extract with its marks rendered as literals of their types."""
    text = entry.sql_query
    if OFFSET_SLOT in text:
        text = text.replace(OFFSET_SLOT, str(int(entry.offset_value)))
    if TIME_SLOT in text:
        text = text.replace(f"'{TIME_SLOT}'", TIME_SLOT).replace(TIME_SLOT, f"'{_ts_text(entry.startdatetime)}'")
    return text


def base_extract(entry: ControlEntry) -> str:
    """The extract that reconciliation counts: without an incremental predicate."""
    text = entry.base_query or entry.sql_query
    if has_mark_slot(text):
        raise ValueError(f"the extract of {entry.tablename} holds a mark placeholder: reconciliation needs "
                         "the control row's base_query, the extract without its incremental predicate")
    return text


def offset_predicate_sql(column: str, offset: int, alias: str = "extract_rows") -> str:
    return f"{alias}.{_ident(column)} <= {int(offset)}"


def count_query(base_query: str, where_sql: str | None = None, hint: str = "") -> str:
    """The pushed-down count as a ``dbtable`` subquery with column ``CNT``."""
    where = f" WHERE {where_sql}" if where_sql else ""
    head = f"SELECT {hint} COUNT(*) AS CNT" if hint else "SELECT COUNT(*) AS CNT"
    return f"({head} FROM ({base_query.strip().rstrip(';')}) extract_rows{where}) counted"


@dataclass(frozen=True)
class JdbcSource:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    dialect: str = "generic"
    fetch_size: int | None = None
    extra: dict = field(default_factory=dict)

    def options(self, dialect: str | None = None) -> dict[str, str]:
        dialect = dialect or self.dialect
        opts = {"url": self.url,
                "fetchsize": str(self.fetch_size or (ORACLE_FETCH_SIZE if dialect == "oracle"
                                                     else GENERIC_FETCH_SIZE))}
        for k, v in (("user", self.user), ("password", self.password), ("driver", self.driver)):
            if v is not None:
                opts[k] = v
        opts.update({k: str(v) for k, v in self.extra.items()})
        return opts

    def read(self, spark: SparkSession, dbtable: str, dialect: str | None = None,
             **more) -> DataFrame:
        reader = spark.read.format("jdbc")
        for k, v in {**self.options(dialect), "dbtable": dbtable, **more}.items():
            reader = reader.option(k, str(v))
        return reader.load()

    def count_frame(self, spark: SparkSession, base_query: str,
                    where_sql: str | None = None, hint: str = "",
                    dialect: str | None = None) -> DataFrame:
        """One row, column ``CNT`` as long: the count runs in the database (SRC-1/2)."""
        df = self.read(spark, count_query(base_query, where_sql, hint), dialect)
        return df.select(F.col("CNT").cast("long").alias("CNT"))

    def entry_count_frame(self, spark: SparkSession, entry: ControlEntry,
                          days: int = DEFAULT_WINDOW_DAYS) -> DataFrame:
        """A control row's source count; dialect and fetch size follow its ``source``."""
        df = self.read(spark, self.source_count_sql(entry, days), entry.dialect)
        return df.select(F.col("CNT").cast("long").alias("CNT"))

    def source_count_sql(self, entry: ControlEntry, days: int = DEFAULT_WINDOW_DAYS) -> str:
        """The ``dbtable`` text for a control row's source count (dialect from the row)."""
        mode = entry.mode
        if mode is LoadMode.FULL:
            return count_query(base_extract(entry))
        hint = ORACLE_PARALLEL_HINT if entry.dialect == "oracle" else ""
        if mode is LoadMode.OFFSET:
            (key,) = split_columns(entry.data_validation_column)
            return count_query(base_extract(entry), offset_predicate_sql(key, entry.offset_value), hint)
        if mode is LoadMode.WINDOW:
            if entry.startdatetime is None:
                raise ValueError("time-window reconciliation needs startdatetime")
            return count_query(base_extract(entry), window_predicate_sql(
                entry.dialect, entry.data_validation_column, entry.startdatetime, days), hint)
        raise ValueError(f"unknown load type {entry.loadtype!r}")

    def extract(self, spark: SparkSession, dbtable: str, partition_column: str | None = None,
                num_partitions: int = 8, lower=None, upper=None) -> DataFrame:
        """Parallel range read (SRC-8).

        With a partition column, about ``num_partitions`` tasks read strides of equally many
        rows, from one equi-depth histogram that the database computes; rows whose column
        is NULL are a stride of their own.  With ``lower`` and ``upper``, the strides are equally
        wide instead and no histogram is asked for (rows outside land in the outer strides).
        """
        fetch = {"fetchsize": self.fetch_size or EXTRACT_FETCH_SIZE}
        if partition_column is None:
            return self.read(spark, dbtable, **fetch)
        col = _ident(partition_column)
        if lower is not None and upper is not None:
            return self.read(spark, dbtable, partitionColumn=col, lowerBound=lower,
                             upperBound=upper, numPartitions=num_partitions, **fetch)
        found = self.read(spark, histogram_query(dbtable, col, num_partitions)).collect()  # a row a stride
        starts = sorted({r["LO"] for r in found if r["LO"] is not None})
        properties = {k: v for k, v in {**self.options(), **{k: str(v) for k, v in fetch.items()}}.items() if k != "url"}
        return spark.read.jdbc(self.url, dbtable, predicates=stride_predicates(col, starts, self.dialect),
                               properties=properties)


def histogram_query(dbtable: str, column: str, strides: int) -> str:
    """The smallest value of each of ``strides`` equally large parts of the column (NULL left out)."""
    col = _ident(column)
    sub = dbtable if dbtable.lstrip().startswith("(") else f"(SELECT * FROM {dbtable}) b"
    return (f"(SELECT STRIDE, MIN({col}) AS LO FROM (SELECT {col}, NTILE({int(strides)}) OVER (ORDER BY {col}) AS STRIDE "
            f"FROM {sub} WHERE {col} IS NOT NULL) parts GROUP BY STRIDE) histogram")


def value_sql(value, dialect: str) -> str:
    """A number, date or timestamp as a literal of the source's SQL dialect."""
    if isinstance(value, bool) or not isinstance(value, (int, float, decimal.Decimal, dt.date)):
        raise ValueError(f"cannot split extracts by a column of {type(value).__name__}")
    if not isinstance(value, dt.date):
        return str(value)
    if not isinstance(value, dt.datetime):
        return f"DATE '{value.isoformat()}'" if dialect == "oracle" else f"CAST('{value.isoformat()}' AS date)"
    if dialect == "oracle":
        return f"TO_TIMESTAMP('{_ts_text(value)}', 'YYYY-MM-DD HH24:MI:SS.FF')"
    return f"CAST('{_ts_text(value)}' AS datetime2(6))"


def stride_predicates(column: str, starts: list, dialect: str) -> list[str]:
    """Predicates that every row meets exactly one of, from the sorted first values of the strides.

    The first stride is open below and the last one above, so rows that came after the
    histogram are read as well.  A value that fills several strides is one: no range splits it.
    """
    col = _ident(column)
    if not starts:  # nothing but NULL, or nothing yet
        return [f"{col} IS NULL", f"{col} IS NOT NULL"]
    cuts = [value_sql(v, dialect) for v in starts[1:]]
    ranges = [[] for _ in range(len(cuts) + 1)]
    for i, cut in enumerate(cuts):
        ranges[i].append(f"{col} < {cut}")
        ranges[i + 1].insert(0, f"{col} >= {cut}")
    return [f"{col} IS NULL"] + [" AND ".join(r) or f"{col} IS NOT NULL" for r in ranges]


@dataclass
class JdbcRelations:
    """Control-row extracts read over JDBC, for loads.

    The extract query becomes a parallel range read when a partition column
    is given; the load's own predicate (rows past the mark) is applied with
    ``where`` and pushed by Spark into the query sent to the database.
    """

    spark: SparkSession
    source: JdbcSource
    partition_column: str | None = None
    num_partitions: int = 8

    def relation(self, entry: ControlEntry, for_load: bool = False) -> tuple[str, DataFrame]:
        dbtable = f"({bound_marks(entry).strip().rstrip(';')}) src"
        return f"jdbc:{entry.id}", self.source.extract(
            self.spark, dbtable, self.partition_column, self.num_partitions)
