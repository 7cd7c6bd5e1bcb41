"""Session helpers: a local session for tests and the bench, and the shared
folder used for lineage cuts and sink round trips.

The library itself never changes session settings; only ``local_session``
(used by tests, the bench and the entry point) sets any configuration.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A ``local[cores]`` session with the UI off and AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("settlekit")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SETTLEKIT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for lineage cuts and written intermediates.

    Read from ``spark.checkpoint.dir`` (or a checkpoint folder already set on
    the context); on a cluster that points at shared storage and is only read
    here. Only in local mode (tests, the bench) is a fresh local folder
    created and set when neither is configured; on a cluster a missing
    setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder (e.g. on HDFS or object storage)")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="settlekit-ckpt-"))
        configured = sc.getCheckpointDir()
    return configured.rstrip("/")
