"""SparkSession settings the jobs rely on, and the shared checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job wants whatever the cluster: adaptive execution (runtime
# broadcast conversion from measured sizes, partition coalescing, skew-join
# splitting) and dynamic partition overwrite for idempotent result writes.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(
    cores: int | str = 8,
    shuffle_partitions: int | None = None,
    app: str = "visitlens",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC clock)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", os.environ.get("VISITLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Sizing for a ~100 TB visit log on ~1000 executors, applied only where the
# cluster has not set a value itself:
#  * 512 MB scan splits: ~200k scan tasks per pass instead of ~800k at 128 MB;
#  * shuffles start wide and AQE coalesces them towards 256 MB partitions
#    (after partial aggregation most shuffles are far smaller than the input);
#  * 64 MB broadcast threshold: the measured bounded sides (top-session ids,
#    drawn sessions) and a user dimension of a few million rows qualify.
SCALE_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def apply_job_conf(spark: SparkSession, scale: bool = False) -> None:
    """Set the job settings on an existing (cluster) session.

    With ``scale`` the SCALE_CONF sizing is added for every key the cluster
    configuration does not already set.
    """
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    if scale:
        configured = spark.sparkContext.getConf()
        default = spark.newSession().conf  # what holds without settings of this session
        for k, v in SCALE_CONF.items():
            if not configured.contains(k) and spark.conf.get(k, None) == default.get(k, None):
                spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A fallback is only used where the session names none (tests); on a
    cluster the setting must point at shared storage.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)  # the cluster's shared folder, named in the session
        return configured
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
