"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on; the cluster may set more.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.aggregatePushdown": "true",
    # Long-lived sessions run the same plan shapes again and again; keep
    # their compiled whole-stage code (static setting, read at start-up).
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
}


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "tracklake",
    event_log_dir: str | None = None,
) -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster).

    ``event_log_dir`` writes Spark's event log there (stage and task times
    without the web UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TRACKLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # No Python call-site capture per API call (error context only); it
        # costs several JVM round trips per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", event_log_dir
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as is. Only a local-mode session without one gets a scratch folder, as in
    tests. A cluster session without one is an error, never a local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for the cluster"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tracklake-ckpt-"))
    return sc.getCheckpointDir()
