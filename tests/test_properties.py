"""Property checks with random inputs (few examples: each one runs Spark)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.functions.predicates import round_to_millis, ts_literal
from lakeops.functions.running import grouped_running_sum

EPOCH = dt.datetime(1970, 1, 1)


def py_round_ms(t: dt.datetime) -> dt.datetime:
    us = (t - EPOCH) // dt.timedelta(microseconds=1)
    shifted = us + 500
    return EPOCH + dt.timedelta(microseconds=shifted - shifted % 1000)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 1, 1)),
                min_size=1, max_size=40))
def test_round_to_millis_matches_python(spark, values):
    df = spark.createDataFrame([(i, v.isoformat(sep=" ")) for i, v in enumerate(values)],
                               "i long, s string")
    got = {r.i: r.r for r in df.select("i", round_to_millis(F.col("s").cast("timestamp_ntz"))
                                       .alias("r")).collect()}
    assert got == {i: py_round_ms(v) for i, v in enumerate(values)}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "hot"]), st.integers(0, 50),
                          st.integers(0, 1000)), min_size=1, max_size=200),
       st.integers(1, 9))
def test_running_sum_matches_window(spark, rows, chunks):
    df = spark.createDataFrame([(g, o, i, v) for i, (g, o, v) in enumerate(rows)],
                               "g string, o long, tie long, v long")
    got = grouped_running_sum(df, ["g"], "o", "v", "rs", tie_cols=["tie"], chunks=chunks)
    w = Window.partitionBy("g").orderBy("o", "tie").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("rs", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert sorted(map(tuple, got.select(*want.columns).collect())) == \
        sorted(map(tuple, want.collect()))


def test_literal_precision():
    assert ts_literal(dt.datetime(2024, 1, 1, 0, 0, 0, 1)) is not None
