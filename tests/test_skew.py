"""Hot groups: one table, partition or key holding a third of all rows.

Inputs are the given tables with one group made hot; results are compared
with a brute-force plain window on the same input.
"""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators import maintenance as mnt
from lakeops.plans import fixtures as fx

from conftest import SF_MID


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_expiry_with_a_table_holding_a_third_of_snapshots(spark):
    ev = fx.read_table(spark, SF_MID, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    got = mnt.expired_snapshots(ev, table_cols=["user_id"], time_col="ts", id_col="event_id",
                                older_than=dt.datetime(2024, 1, 26), retain_last=2)
    w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    want = ev.withColumn("rk", F.row_number().over(w)).where(
        (F.col("rk") > 2) & (F.col("ts") < F.lit("2024-01-26").cast("timestamp_ntz"))).drop("rk")
    assert _same(got.select(*ev.columns), want)


def test_compaction_bins_with_a_partition_holding_a_third_of_files(spark):
    docs = fx.read_table(spark, SF_MID, "documents").select("doc_id", "source", "n_chars").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, F.lit("hot")).otherwise(F.col("source")))
    got = mnt.compaction_plan(docs, partition_cols=["source"], order_col="doc_id",
                              size_col="n_chars", target_bytes=50000, chunks=8)
    cand = docs.where((F.col("n_chars") < 37500) | (F.col("n_chars") > 90000))
    w = Window.partitionBy("source").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    want = cand.withColumn("bytes_before", F.coalesce(F.sum("n_chars").over(w), F.lit(0))) \
        .withColumn("bin", (F.col("bytes_before") / 50000).cast("long"))
    assert _same(got.select(*want.columns), want)
    hot = got.where(F.col("source") == "hot").count()
    assert hot * 4 > got.count()   # the hot partition really holds a large share


def test_merge_replaces_every_row_of_a_hot_target_key(spark):
    from lakeops.operators.ingest import LakeLocation, load_full, load_merge
    from lakeops.session import scratch_path

    orders = fx.read_table(spark, SF_MID, "orders")
    hot = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1))
                            .otherwise(F.col("o_custkey")))
    lake = LakeLocation(spark, root=scratch_path(spark, "t-hot"))
    load_full(hot, lake, "o")
    update = hot.where(F.col("o_custkey") == -1).limit(1).withColumn("o_totalprice", F.lit(-5.0))
    load_merge(update, lake, "o", ["o_custkey"], unique_keys=True)
    back = lake.read("o")
    assert back.where(F.col("o_custkey") == -1).count() == 1
    assert back.where(F.col("o_custkey") == -1).first().o_totalprice == -5.0
    assert back.count() == hot.where(F.col("o_custkey") != -1).count() + 1
