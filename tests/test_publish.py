"""Loads that break at any step, and what the next call makes of them."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops import jobs
from lakeops.operators import publish as pub
from lakeops.operators.audit import append_audit, append_once, read_audit
from lakeops.operators.control import CONTROL_SCHEMA, ControlEntry
from lakeops.operators.ingest import (LakeLocation, load_full, load_incremental, load_merge, overwrite_partitions,
                                      run_ingestion)
from lakeops.operators.ledger import LoadLedger
from lakeops.plans.recovery import DriverLost, dying_at
from lakeops.session import scratch_path
from lakeops.sources.lake import SparkSources

DDL = "k long, p string, v long"


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or ("k", "p", "v"))).collect()), key=repr)


@pytest.fixture(params=["folder", "catalog"])
def lake(request, spark):
    root = scratch_path(spark, "t-publish")
    if request.param == "folder":
        yield LakeLocation(spark, root=root)
        return
    name = "t_publish_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}'")
    yield LakeLocation(spark, database=name)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def base(spark):
    return spark.createDataFrame([(1, "a b", 1), (2, "x%y", 1), (3, None, 1), (4, "01", 1)], DDL)


def left_over(spark, lake):
    folder = f"{lake.home}/_publish"
    fs, p = pub.Files(spark).at(folder)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def broken(spark):
    return spark.range(100).select(
        F.col("id").alias("k"), F.lit("a b").alias("p"),
        F.when(F.col("id") == 99, F.raise_error(F.lit("source lost")).cast("bigint")).otherwise(F.col("id")).alias("v"))


@pytest.mark.parametrize("by", [None, ["p"]])
def test_a_failing_extract_changes_nothing(spark, lake, by):
    load_full(base(spark), lake, "t", by)
    for load in (lambda: load_full(broken(spark), lake, "t"), lambda: load_incremental(broken(spark), lake, "t", "k", 5),
                 lambda: load_merge(broken(spark), lake, "t", ["k"])):
        with pytest.raises(Exception, match="source lost"):
            load()
        assert rows_of(lake.read("t")) == rows_of(base(spark))
    assert lake.finish("t") is None


STEPS = {"append": ["append", "note", "record"], "swap": ["swap", "note", "record"], "replace": ["replace", "note", "record"]}


@pytest.mark.parametrize("step", STEPS["replace"])
def test_replace_is_finished_by_the_next_call(spark, lake, step):
    load_full(base(spark), lake, "t", ["p"])
    new = spark.createDataFrame([(7, "a b", 7), (8, "new", 8)], DDL)
    with pytest.raises(DriverLost):
        load_full(new, dataclasses.replace(lake, watch=dying_at("t", step)), "t")
    assert lake.finish("t").kind == pub.REPLACE and lake.finish("t") is None
    assert rows_of(lake.read("t")) == rows_of(new) and lake.partitions("t") == ["p"] and left_over(spark, lake) == []


@pytest.mark.parametrize("step,skip", [("append", 0), ("append", 1), ("note", 0), ("record", 0)])
def test_append_is_finished_by_the_next_call(spark, lake, step, skip):
    load_full(base(spark), lake, "t", ["p"])
    more = spark.createDataFrame([(11, "a b", 2), (12, "new", 2), (13, None, 2)], DDL).repartition(3)
    with pytest.raises(DriverLost):
        load_incremental(more, dataclasses.replace(lake, watch=dying_at("t", step, skip)), "t", "k", 4)
    # The next load of the table finishes the old one first.
    load_incremental(spark.createDataFrame([(20, "z", 3)], DDL), lake, "t", "k", 13)
    assert rows_of(lake.read("t")) == sorted(rows_of(base(spark)) + rows_of(more) + [(20, "z", 3)], key=repr)
    assert left_over(spark, lake) == []


@pytest.mark.parametrize("step,skip", [("swap", 0), ("swap", 1), ("remove", 0), ("note", 0)])
def test_merge_is_finished_by_the_next_call(spark, lake, step, skip):
    load_full(base(spark), lake, "t", ["p"])
    moved = spark.createDataFrame([(1, "z", 9), (2, "x%y", 9), (3, None, 9)], DDL)  # "a b" ends up empty
    with pytest.raises(DriverLost):
        load_merge(moved, dataclasses.replace(lake, watch=dying_at("t", step, skip)), "t", ["k"])
    assert lake.finish("t").kind == pub.SWAP
    assert rows_of(lake.read("t")) == sorted([(1, "z", 9), (2, "x%y", 9), (3, None, 9), (4, "01", 1)], key=repr)
    load_merge(moved, lake, "t", ["k"])
    assert lake.read("t").count() == 4 and left_over(spark, lake) == []


def test_partitions_replaced_are_those_of_the_rows(spark, lake):
    load_full(base(spark), lake, "t", ["p"])
    overwrite_partitions(spark.createDataFrame([(9, "a b", 9), (10, "new", 9)], DDL), lake, "t", ["p"])
    assert rows_of(lake.read("t")) == sorted([(9, "a b", 9), (10, "new", 9), (2, "x%y", 1), (3, None, 1), (4, "01", 1)], key=repr)


def test_a_full_load_keeps_an_external_tables_place_and_comment(spark, lake):
    if lake.root:
        pytest.skip("catalog tables only")
    outside = scratch_path(spark, "outside")
    name = lake.name("ext")
    spark.sql(f"CREATE TABLE {name} (k BIGINT, v BIGINT, p STRING) USING parquet PARTITIONED BY (p) LOCATION '{outside}' COMMENT 'it''s ours'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner_team' = 'us')")
    before = {k: v for k, v in lake.details("ext").items() if k in ("Location", "Type", "Comment", "Provider")}
    for rows in ([(1, "a", 1), (2, "b", 1)], [(3, "b", 2)]):
        load_full(spark.createDataFrame(rows, DDL), lake, "ext")
        assert rows_of(spark.table(name)) == rows
        assert rows_of(spark.read.parquet(outside)) == rows  # no stale rows in the old folder
        assert {k: v for k, v in lake.details("ext").items() if k in before} == before
        assert lake._properties("ext")["owner_team"] == "us"
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["p=b"]
    # Other columns than before: written anew, still external, at the same place.
    load_full(spark.createDataFrame([(5, "c", 1, True)], DDL + ", extra boolean"), lake, "ext")
    assert lake.details("ext")["Location"] == before["Location"] and lake.details("ext")["Type"] == "EXTERNAL"
    assert lake.details("ext")["Comment"] == "it's ours" and spark.table(name).columns.count("extra") == 1


def test_tables_whose_files_cannot_be_moved(spark, lake):
    if lake.root:
        pytest.skip("catalog tables only")
    base(spark).write.format("json").partitionBy("p").saveAsTable(lake.name("j"))
    base(spark).write.bucketBy(2, "k").sortBy("k").saveAsTable(lake.name("b"))
    for t in ("j", "b"):
        load_full(base(spark).where("k > 1"), lake, t)
        load_incremental(base(spark), lake, t, "k", 3)
        load_merge(spark.createDataFrame([(2, "x%y", 50)], DDL), lake, t, ["k"])
        assert rows_of(lake.read(t)) == sorted([(2, "x%y", 50), (3, None, 1), (4, "01", 1), (4, "01", 1)], key=repr)
    assert lake.details("b")["Num Buckets"] == "2" and lake.details("j")["Provider"].lower() == "json"


def test_only_written_partitions_are_told_to_the_catalog(spark, lake, monkeypatch):
    if lake.root:
        pytest.skip("catalog tables only")
    many = spark.range(150).select(F.col("id").alias("k"), F.col("id").cast("string").alias("p"), F.lit(1).cast("bigint").alias("v"))
    many.write.partitionBy("p").saveAsTable(lake.name("m"))
    told = []
    run = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **kw: (told.append(text), run(self, text, *a, **kw))[1])
    monkeypatch.setattr(type(spark.catalog), "recoverPartitions", lambda *a: pytest.fail("lists every partition"))
    load_merge(spark.createDataFrame([(1, "1", 5), (900, "new", 5)], DDL), lake, "m", ["k"])
    added = [t for t in told if "ADD IF NOT EXISTS" in t]
    assert len(added) == 1 and added[0].count("PARTITION (") == 2
    assert spark.table(lake.name("m")).count() == 151


def control(spark, *entries):
    return spark.createDataFrame([tuple(
        {"active": 1, "data_validation_required": 1}.get(f.name, getattr(e, f.name, None)) for f in CONTROL_SCHEMA)
        for e in entries], CONTROL_SCHEMA)


@pytest.mark.parametrize("step", ["append", "note", "record", None])
def test_a_repeated_run_appends_once(spark, lake, step):
    spark.range(10).select(F.col("id").alias("k"), F.lit("a").alias("p"), F.col("id").alias("v")).createOrReplaceTempView("ten")
    ctl = control(spark, ControlEntry(1, 1, "SELECT * FROM ten WHERE k > {offset_value}", "x", "t", "incremental", None, "k", -1))
    load_full(spark.table("ten").where("k < 0"), lake, "t")
    audit = scratch_path(spark, "t-audit")
    first = dataclasses.replace(lake, watch=dying_at("t", step)) if step else lake
    jobs.ingest(spark, ctl, 1, first, job_name="J", audit_target=audit, batch="1_1")
    for _ in range(2):  # the marks were never saved
        run, moved = jobs.ingest(spark, ctl, 1, lake, job_name="J", audit_target=audit, batch="1_1")
        assert lake.read("t").count() == 10 and run.succeeded == 1 and moved.first()["offset_value"] == 9
    assert read_audit(spark, audit).where("STATUS = 'SUCCESS'").count() == 1
    # Rows that came meanwhile are loaded, and only they.
    spark.range(14).select(F.col("id").alias("k"), F.lit("a").alias("p"), F.col("id").alias("v")).createOrReplaceTempView("ten")
    run, _ = jobs.ingest(spark, ctl, 1, lake, job_name="J", audit_target=audit, batch="2_1")
    assert run.audit.first()["ROWS_LOADED"] == 4 and lake.read("t").count() == 14


def test_the_ledger_follows_time_marks_and_forgets(spark, lake):
    d = dt.datetime
    ledger = LoadLedger(spark, scratch_path(spark, "t-ledger"))
    e = ControlEntry(1, 1, "q", "x", "t", "Incremental", d(2024, 1, 1), "at")
    for old, new in ((d(2024, 1, 1), d(2024, 2, 1, 0, 0, 0, 5)), (d(2024, 2, 1, 0, 0, 0, 5), d(2024, 3, 1))):
        note = ledger.intend(dataclasses.replace(e, startdatetime=old), "b")
        for _ in range(2):
            ledger.commit({**note, "NEW_MARK": new.isoformat(sep=" ", timespec="microseconds"), "ROWS_LOADED": 1})
    assert ledger.read().where("STATE = 'COMMIT'").count() == 2  # told twice, there once
    assert ledger.resumed(e, True).startdatetime == d(2024, 3, 1)
    assert ledger.resumed(e, False) == e and ledger.resumed(dataclasses.replace(e, id=2), True).startdatetime == d(2024, 1, 1)
    ledger.forget("t")
    assert ledger.resumed(e, True) == e


def test_append_once_by_null_safe_keys(spark):
    target = scratch_path(spark, "t-once")
    rows = spark.createDataFrame([("b", 1, None), ("b", 2, "t"), (None, 1, None)], "BATCH_NUMBER string, ID long, TABLE_NAME string")
    for _ in range(2):
        append_once(rows, target, ["BATCH_NUMBER", "ID", "TABLE_NAME"])
    append_audit(rows.withColumn("BATCH_NUMBER", F.lit("c")), scratch_path(spark, "t-other"))
    assert read_audit(spark, target).count() == 3


def test_rows_of_a_run_are_told_as_tables_finish(spark, lake):
    spark.range(3).createOrReplaceTempView("three")
    seen = []
    entries = [ControlEntry(i, 1, "SELECT * FROM three", "x", f"t{i}", "Full Load" if i != 2 else "Odd") for i in (1, 2, 3)]
    run_ingestion(spark, entries, SparkSources(spark), lake, job_name="J", batch="B",
                  on_row=lambda df: seen.append((df.first()["ID"], df.first()["STATUS"], lake.exists("t3"))))
    assert seen == [(1, "SUCCESS", False), (2, "FAILED", False), (3, "SUCCESS", True)]


def test_appends_at_once_do_not_disturb_each_other(spark):
    from concurrent.futures import ThreadPoolExecutor
    root = scratch_path(spark, "t-at-once")
    name = "t_at_once_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/db'")
    for target in (f"{root}/audit", f"{name}.audit"):
        rows = [spark.createDataFrame([("b", i, "t")], "BATCH_NUMBER string, ID long, TABLE_NAME string") for i in range(12)]
        with ThreadPoolExecutor(6) as pool:
            list(pool.map(lambda df: append_once(df, target, ["BATCH_NUMBER", "ID"]), rows))
        assert read_audit(spark, target).count() == 12
    spark.sql(f"DROP DATABASE {name} CASCADE")
