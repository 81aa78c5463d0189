"""Session helpers.

Jobs read their settings from the active session. The only thing set here on
an existing session is a checkpoint folder, and only when the cluster has not
named one (``spark.checkpoint.dir``), which is the case in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Set by ``local_session`` only: small scans are spread over the local cores.
SPREAD_CONF = "spark.shapeloom.spreadScans"

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # bench and tests read one-row-group files; see ``spread``
    SPREAD_CONF: "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shapeloom", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("SHAPELOOM_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the reliable checkpoint folder, setting one only if none is named.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage and is
    used as is; without it this raises. A local master (tests) gets a fresh
    scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not fallback and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = fallback or tempfile.mkdtemp(prefix="shapeloom-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


def scratch_table_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def spread(df, min_partitions: int | None = None):
    """Give a scan at least one partition per core.

    A table stored as one Parquet row group is read by a single task, and every
    narrow operator above it (regexes, tokenising, geometry) would then run on
    one core. Sessions made by ``local_session`` (bench and tests) set
    ``SPREAD_CONF`` and have scans spread round-robin; any other session reads
    the scan as it is.
    """
    spark = df.sparkSession
    if spark.conf.get(SPREAD_CONF, "false") != "true":
        return df
    return df.repartition(min_partitions or spark.sparkContext.defaultParallelism)
