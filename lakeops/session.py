"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  AQE re-plans joins at run
# time from real shuffle sizes (broadcast only when the measured side is under
# ``spark.sql.autoBroadcastJoinThreshold``) and splits skewed partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.filterPushdown": "true",
    # Skip PySpark's per-call Python call-site capture: with hundreds of
    # control rows a batch builds thousands of column expressions, and the
    # capture (a stack inspection per call) dominated planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Concurrent jobs (loads, counts of several tables) share the executors.
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "lakeops",
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster that folder is shared storage every executor can reach, so
    it also serves for intermediate tables that cut lineage.  Only a local
    session that names none gets a private temporary folder; on a cluster each
    executor would write to its own disk there, so that is refused.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return configured.rstrip("/")
    root = sc.getCheckpointDir()
    if root is None:
        configured = sc.getConf().get("spark.checkpoint.dir", None) \
            or spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not sc.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            configured = tempfile.mkdtemp(prefix="lakeops-")
        sc.setCheckpointDir(configured)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch location this package made, once its consumer committed.

    Staged merges can be as large as the partitions they rewrite, so they are
    not left behind in the shared folder.  Failures are ignored: a leftover
    only costs space.
    """
    if not path.startswith(scratch_root(spark)):
        raise ValueError(f"not a scratch location: {path}")
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001
        pass
