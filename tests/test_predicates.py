"""Window edges, millisecond rounding and value formatters."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.functions import formatting as fm
from lakeops.functions.predicates import (lake_window, round_to_millis, source_window,
                                          split_columns, ts_literal)

MARK = "2024-01-31 00:00:00"
# id, value, FLT-2 micros bounded, FLT-3 millis bounded, FLT-4 open above
EDGES = [
    (1, "2024-01-31 00:00:00", True, True, True),
    (2, "2024-01-01 00:00:00", False, False, False),
    (3, "2024-01-01 00:00:00.000001", True, False, True),
    (4, "2024-01-31 00:00:00.0004", False, True, True),
    (5, "2024-01-31 00:00:00.0006", False, False, True),
    (6, None, False, False, False),
    (7, "bad", False, False, False),
    (8, "2024-01-15 12:00:00", True, True, True),
    (9, "2024-02-10 00:00:00", False, False, True),
]


def test_window_edges(spark):
    df = spark.createDataFrame([(i, v) for i, v, *_ in EDGES], "id long, v string") \
        .withColumn("t", F.col("v").try_cast("timestamp_ntz"))
    mark = ts_literal(MARK)
    got = df.select(
        "id",
        F.coalesce(source_window(["t"], mark, "oracle"), F.lit(False)).alias("f2"),
        F.coalesce(source_window(["v"], mark, "mssql"), F.lit(False)).alias("f3"),
        F.coalesce(lake_window(["t"], mark), F.lit(False)).alias("f4"),
    ).orderBy("id").collect()
    assert [(r.id, r.f2, r.f3, r.f4) for r in got] == [(i, a, b, c) for i, _, a, b, c in EDGES]


def test_coalesce_takes_first_convertible(spark):
    df = spark.createDataFrame([("bad", "2024-01-20 00:00:00"), (None, "2024-01-21 00:00:00"),
                                ("2024-01-10 00:00:00", "2023-01-01 00:00:00")], "a string, b string")
    n = df.where(source_window(["a", "b"], ts_literal("2024-01-31"), "mssql")).count()
    assert n == 3


@pytest.mark.parametrize("raw,expected", [
    ("2024-01-01 00:00:00.0004", "2024-01-01 00:00:00"),
    ("2024-01-01 00:00:00.0005", "2024-01-01 00:00:00.001"),
    ("2024-01-01 23:59:59.9996", "2024-01-02 00:00:00"),
    ("1969-12-31 23:59:59.9994", "1969-12-31 23:59:59.999"),
])
def test_round_to_millis(spark, raw, expected):
    row = spark.range(1).select(round_to_millis(ts_literal(raw)).alias("r"),
                                ts_literal(expected).alias("e")).first()
    assert row.r == row.e


def test_rounding_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = spark.range(1).select(round_to_millis(ts_literal("2024-03-10 02:30:00.0007")).alias("r")).first()
        assert row.r == dt.datetime(2024, 3, 10, 2, 30, 0, 1000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_ts_literal_is_ntz(spark):
    row = spark.range(1).select(ts_literal(dt.datetime(2024, 2, 9, 1, 2, 3, 4)).alias("t"))
    assert row.schema["t"].dataType.typeName() == "timestamp_ntz"
    assert row.first().t == dt.datetime(2024, 2, 9, 1, 2, 3, 4)


def test_split_columns():
    assert split_columns(" modified_on, created_on ") == ["modified_on", "created_on"]
    assert split_columns("x") == ["x"]
    with pytest.raises(ValueError):
        split_columns(" , ")
    with pytest.raises(ValueError, match="no validation column"):
        split_columns(None)


def test_formatters(spark):
    assert fm.hms(400000) == "111:06:40"
    assert fm.hms(59.9) == "00:00:59"
    assert fm.hms_words(3723) == "01 Hour 02 Minutes 03 Seconds"
    assert fm.batch_number(1, dt.datetime(2024, 12, 1, tzinfo=dt.timezone.utc)) == "1733011200_1"
    assert len(fm.truncate_error("x" * 5000)) == 1000
    assert fm.hms(400000) == "111:06:40" and fm.hms(None) is None and fm.hms_words(None) is None
