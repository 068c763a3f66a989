"""Session builder for tests, benchmarks and local runs.

On a cluster, use the session the platform gives you; these settings are
the ones the library relies on (AQE for runtime join/skew/coalesce choices).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "obsgate") -> SparkSession:
    """A session on this machine; its own folder stands in for the cluster's shared one and goes with the process."""
    shared = tempfile.mkdtemp(prefix="obsgate-shared-")
    atexit.register(shutil.rmtree, shared, ignore_errors=True)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{shared}/checkpoints")
        .config("spark.sql.warehouse.dir", f"file://{shared}/warehouse")
        .config("spark.driver.memory", os.environ.get("OBSGATE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
