"""Job entry points end to end on the fixture control table."""

from pyspark.sql import functions as F

from lakeops import jobs
from lakeops.operators.audit import read_audit
from lakeops.operators.ingest import LakeLocation
from lakeops.plans import fixtures as fx
from lakeops.session import scratch_path

from conftest import SF_SMALL


def test_validate_appends_one_row_per_table(spark):
    fx.register(spark, SF_SMALL)
    audit = scratch_path(spark, "audit")
    ctl = fx.control_table(spark, SF_SMALL)
    run = jobs.validate(spark, ctl, 1, job_name="V", audit_target=audit)
    jobs.validate(spark, ctl, 1, job_name="V", audit_target=audit)
    back = read_audit(spark, audit)
    assert back.count() == 10
    assert back.columns.index("INSERT_TIMESTAMP") == back.columns.index("START_OFFSET") + 1
    assert run.batch.endswith("_1")
    got = {r.ID: (r.SOURCE_COUNT, r.DATALAKE_COUNT) for r in run.result.audit.collect()}
    assert got[1] == (1500, 1470) and got[2] == (71, 2626) and got[3] == (751, 732)
    assert got[4] == (703, 686)


def test_ingest_job_advances_marks(spark):
    fx.register(spark, SF_SMALL)
    lake = LakeLocation(spark, root=scratch_path(spark, "lake"))
    ctl = fx.control_table(spark, SF_SMALL).where(F.col("id").isin(1, 3))
    run, moved = jobs.ingest(spark, ctl, 1, lake, job_name="I")
    assert run.succeeded == 2
    marks = {r.id: r.offset_value for r in moved.collect()}
    assert marks[3] == fx.read_table(spark, SF_SMALL, "events").count() - 1


def test_maintain_plans_without_touching_files(spark):
    db = "t_jobs_maint"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'wh')}'")
    spark.range(1000).repartition(8).write.saveAsTable(f"{db}.t")
    rows = {r.STEP: r.STATUS for r in jobs.maintain(spark, [db], target_bytes=1 << 20).collect()}
    assert rows["rewrite_data_files"] == "PLANNED" and rows["expire_snapshots"] == "SKIPPED"


def test_cli_validate_and_maintain(spark):
    fx.register(spark, SF_SMALL)
    fx.control_table(spark, SF_SMALL).createOrReplaceTempView("cli_control")
    audit = scratch_path(spark, "cli-audit")
    assert jobs.main(["validate", "--control", "cli_control", "--group", "1",
                      "--audit", audit, "--job-name", "CLI", "--days", "30"]) == 0
    rows = read_audit(spark, audit).collect()
    assert len(rows) == 5 and {r.JOB_NAME for r in rows} == {"CLI"}
    db = "t_cli_maint"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, 'wh')}'")
    assert jobs.main(["maintain", "--databases", db]) == 0


def test_cli_ingest_persists_advanced_marks_over_its_own_control(spark):
    fx.register(spark, SF_SMALL)
    ctl_path = scratch_path(spark, "ctl")
    fx.control_table(spark, SF_SMALL).where(F.col("id").isin(1, 3)).write.parquet(ctl_path)
    spark.read.parquet(ctl_path).createOrReplaceTempView("cli_ctl")
    lake_root = scratch_path(spark, "cli-lake")
    assert jobs.main(["ingest", "--control", "cli_ctl", "--group", "1", "--lake-root", lake_root,
                      "--control-out", ctl_path, "--parallel", "2"]) == 0
    marks = {r.id: r.offset_value for r in spark.read.parquet(ctl_path).collect()}
    assert marks[3] == fx.read_table(spark, SF_SMALL, "events").count() - 1
