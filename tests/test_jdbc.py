"""JDBC count text and reader options.

No database is started here (none may be opened by the tests), so these
tests check the generated SQL and the options handed to Spark's reader.
"""

import datetime as dt

import duckdb
import pytest

from lakeops.operators.control import ControlEntry
from lakeops.sources import jdbc


def test_count_query_wraps_extract():
    q = jdbc.count_query("SELECT * FROM t WHERE a = 1;", "extract_rows.k <= 5")
    assert q == "(SELECT COUNT(*) AS CNT FROM (SELECT * FROM t WHERE a = 1) extract_rows WHERE extract_rows.k <= 5) counted"


def test_window_predicates_by_dialect():
    mark = dt.datetime(2024, 2, 9)
    ora = jdbc.window_predicate_sql("oracle", "a, b", mark)
    assert ora.startswith("COALESCE(extract_rows.a, extract_rows.b) > TO_TIMESTAMP('2024-02-09 00:00:00.000000'")
    assert "INTERVAL '30' DAY AND COALESCE(extract_rows.a, extract_rows.b) <= TO_TIMESTAMP(" in ora
    gen = jdbc.window_predicate_sql("generic", "a", mark, days=7)
    assert gen == ("TRY_CONVERT(datetime2(3), extract_rows.a) > DATEADD(DAY, -7, "
                   "CAST(CAST('2024-02-09 00:00:00.000000' AS datetime2(6)) AS datetime2(3))) AND "
                   "TRY_CONVERT(datetime2(3), extract_rows.a) <= CAST(CAST('2024-02-09 00:00:00.000000' AS datetime2(6)) AS datetime2(3))")


def test_marks_keep_all_digits_and_the_database_rounds_them():
    text = jdbc.window_predicate_sql("generic", "a", dt.datetime(2024, 2, 9, 0, 0, 0, 1500))
    assert "CAST(CAST('2024-02-09 00:00:00.001500' AS datetime2(6)) AS datetime2(3))" in text


def test_marks_in_extracts():
    text = "SELECT * FROM t WHERE k > {offset_value} AND at > TO_TIMESTAMP('{startdatetime}', 'f')"
    e = ControlEntry(1, 1, text, "oracle", "t", "merge", dt.datetime(2024, 1, 2), "k", 7)
    assert jdbc.bound_marks(e) == ("SELECT * FROM t WHERE k > 7 AND at > "
                                   "TO_TIMESTAMP('2024-01-02 00:00:00.000000', 'f')")
    with pytest.raises(ValueError, match="base_query"):
        jdbc.JdbcSource("jdbc:x://h/db").source_count_sql(e)


def test_identifiers_are_validated():
    with pytest.raises(ValueError):
        jdbc.window_predicate_sql("oracle", "a; DROP TABLE x", dt.datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        jdbc.offset_predicate_sql("k or 1=1", 3)


def test_source_count_sql_per_mode():
    src = jdbc.JdbcSource("jdbc:x://h/db", "u", "p", "drv", dialect="oracle")
    full = ControlEntry(1, 1, "SELECT * FROM t", "oracle", "t", "Full Load")
    off = ControlEntry(2, 1, "SELECT * FROM t", "oracle", "t", "merge", None, "k", 42)
    assert src.source_count_sql(full) == "(SELECT COUNT(*) AS CNT FROM (SELECT * FROM t) extract_rows) counted"
    text = src.source_count_sql(off)
    assert jdbc.ORACLE_PARALLEL_HINT in text and text.endswith("WHERE extract_rows.k <= 42) counted")


def test_dialect_follows_the_control_row():
    src = jdbc.JdbcSource("jdbc:x://h/db")           # one connection, as in the original job
    ora = ControlEntry(1, 1, "SELECT * FROM t", "oracle", "t", "merge", dt.datetime(2024, 1, 1), "c")
    gen = ControlEntry(2, 1, "SELECT * FROM t", "mssql", "t", "merge", dt.datetime(2024, 1, 1), "c")
    assert "TO_TIMESTAMP" in src.source_count_sql(ora) and jdbc.ORACLE_PARALLEL_HINT in src.source_count_sql(ora)
    assert "TRY_CONVERT" in src.source_count_sql(gen) and "PARALLEL" not in src.source_count_sql(gen)
    assert src.options("oracle")["fetchsize"] == "100000"


def test_reader_options():
    ora = jdbc.JdbcSource("jdbc:o", "u", "p", "d", dialect="oracle").options()
    gen = jdbc.JdbcSource("jdbc:g", dialect="generic").options()
    assert ora["fetchsize"] == "100000" and gen["fetchsize"] == "1000000"
    assert "user" not in gen and ora["driver"] == "d"


def test_strides_cover_every_row_once():
    starts = [3, 10, 40]
    preds = jdbc.stride_predicates("k", starts, "generic")
    assert preds == ["k IS NULL", "k < 10", "k >= 10 AND k < 40", "k >= 40"]
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (VALUES (NULL), (1), (3), (9), (10), (39), (40), (99)) v(k)")
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in preds]
    assert counts == [1, 3, 2, 2]
    assert con.execute("SELECT count(*) FROM t WHERE " + " OR ".join(f"({p})" for p in preds)).fetchone()[0] == 8
    assert jdbc.stride_predicates("k", [], "generic") == ["k IS NULL", "k IS NOT NULL"]
    assert jdbc.stride_predicates("k", [7], "generic") == ["k IS NULL", "k IS NOT NULL"]


def test_the_histogram_splits_skewed_keys_evenly():
    """The text runs as it is in DuckDB: most rows have small keys, a few are far away."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i < 990 THEN i ELSE i * 1000000 END AS k FROM range(1000) r(i)")
    found = con.execute(f"SELECT * FROM {jdbc.histogram_query('t', 'k', 4)} ORDER BY LO").fetchall()
    preds = jdbc.stride_predicates("k", [lo for _, lo in found], "generic")
    assert [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in preds] == [0, 250, 250, 250, 250]


def test_stride_literals_by_dialect():
    at = dt.datetime(2024, 2, 9, 1, 2, 3, 4)
    assert jdbc.value_sql(at, "oracle") == "TO_TIMESTAMP('2024-02-09 01:02:03.000004', 'YYYY-MM-DD HH24:MI:SS.FF')"
    assert jdbc.value_sql(at, "generic") == "CAST('2024-02-09 01:02:03.000004' AS datetime2(6))"
    assert jdbc.value_sql(dt.date(2024, 2, 9), "oracle") == "DATE '2024-02-09'"
    for bad in ("x'; DROP TABLE t", True, None):
        with pytest.raises(ValueError):
            jdbc.value_sql(bad, "generic")


class FakeReader:
    """Stands in for Spark's reader: remembers what it is asked."""

    def __init__(self, rows):
        self.rows, self.asked = rows, []

    @property
    def read(self):
        return self

    def format(self, name):
        self.asked.append({"format": name})
        return self

    def option(self, key, value):
        self.asked[-1][key] = value
        return self

    def load(self):
        return self

    def collect(self):
        return self.rows

    def jdbc(self, url, table, predicates=None, properties=None):
        self.asked.append({"url": url, "table": table, "predicates": predicates, "properties": properties})
        return self


def test_extract_hands_strides_over_as_predicates():
    fake = FakeReader([{"STRIDE": 2, "LO": 50}, {"STRIDE": 1, "LO": 1}])
    src = jdbc.JdbcSource("jdbc:x://h/db", "u", "p", "drv")
    src.extract(fake, "(SELECT * FROM t) src", "k", 2)
    histogram, extract = fake.asked
    assert "NTILE(2) OVER (ORDER BY k)" in histogram["dbtable"] and "WHERE k IS NOT NULL" in histogram["dbtable"]
    assert extract["predicates"] == ["k IS NULL", "k < 50", "k >= 50"]
    assert extract["properties"] == {"fetchsize": "10000", "user": "u", "password": "p", "driver": "drv"}
    fake = FakeReader([])
    src.extract(fake, "t", "k", 4, lower=0, upper=100)
    (wide,) = fake.asked
    assert wide["partitionColumn"] == "k" and wide["numPartitions"] == "4"
