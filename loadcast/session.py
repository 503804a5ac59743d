"""Session settings every job relies on.

Only settings that change results (time zone) or plans (AQE, broadcast thresholds) are set here;
cluster sizing stays with the deployment.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Joins against a side whose *measured* size is below this threshold become broadcast
# joins at runtime (AQE); everything else stays a shuffle join.
RUNTIME_BROADCAST_BYTES = 64 * 1024 * 1024


def pin_session(spark: SparkSession) -> SparkSession:
    """Pin the settings the jobs depend on: UTC session time zone, AQE with skew handling."""
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(RUNTIME_BROADCAST_BYTES))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; set a scratch one only when the deployment left it unset (tests)."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder; a machine-local one does not survive executor loss")
    path = tempfile.mkdtemp(prefix="loadcast-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def get_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session builder. On a cluster, use the deployment's session and call ``pin_session``."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName("loadcast")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return pin_session(spark)
