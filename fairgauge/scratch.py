"""Tables that a query writes once and reads again, in the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the session's checkpoint
    folder. Where neither is set there is no folder that all executors share for sure: only
    a session whose executors are the driver itself may then use a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fairgauge-llm-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/fairgauge-llm/{name}-{uuid.uuid4().hex}"


#: Paths of scratch tables, while a stage that will drop them is being built.
_noted: list[str] | None = None


@contextmanager
def noted_scratch(paths: list[str]) -> Iterator[None]:
    """Scratch tables that are written meanwhile are added to ``paths``."""
    global _noted
    before, _noted = _noted, paths
    try:
        yield
    finally:
        _noted = before


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete noted scratch tables, once nothing that reads them will run again."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    while paths:
        path = hadoop(paths.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Whether shuffle files go when the query that made them ends; otherwise they stay until
#: the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that begin meanwhile remove their shuffle files when they end."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table of its own in the shared scratch folder and read
    it back: later reads neither recompute it nor depend on any executor, and the
    shuffle files behind it are of no more use."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _noted is not None:
        _noted.append(path)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
