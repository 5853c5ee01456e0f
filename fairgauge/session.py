"""Session helper: the settings this job relies on, applied only where the
cluster has not set them already."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Settings the job wants; an existing value on the session wins.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "fairgauge") -> SparkSession:
    """A local session for tests and the bench (UI off, no ports beyond
    Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FAIRGAUGE_DRIVER_MEMORY", "8g"))
        # Recording the Python call site of every DataFrame/Column call only
        # decorates error messages, and costs a third of plan-building time
        # for this job's large expression trees.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
