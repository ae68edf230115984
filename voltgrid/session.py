"""Session construction and cluster-level settings.

The library never creates a hidden session: operators use the session of
their input DataFrames. ``build_session`` is for tests, the bench and scripts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, ANSI on (the
# Spark 4 default, hence try_divide/try_cast throughout), AQE for runtime
# partition coalescing and skew-join splitting.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # building a Column walks the Python stack for error messages otherwise
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "voltgrid", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, submit with the cluster's own master
    and size ``spark.sql.shuffle.partitions`` to ~128 MB per shuffle partition
    (AQE coalesces the small ones)."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("VOLTGRID_DRIVER_MEMORY", "8g")))
    for k, v in {**CORE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session leaves it unset (local tests) do we pick a fresh
    scratch folder ourselves; on a cluster the configured shared path wins.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return conf
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder is invisible to other executors: refuse
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) "
                           "for checkpoints and streaming state")
    path = tempfile.mkdtemp(prefix="voltgrid-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(path)
    return path
