"""Scratch tables: what a query writes once and reads again."""

from __future__ import annotations

import time

from fairgauge.scratch import SHUFFLE_CLEANUP, materialise
from pyspark.sql import functions as F


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def test_shuffles_behind_a_written_table_are_removed(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    df = spark.range(50_000).repartition(7, "id").groupBy((F.col("id") % 1000).alias("k")).agg(F.sum("id").alias("n"))
    table = materialise(df, "test-scratch")
    left, until = shuffle_files(spark) - before, time.time() + 5
    while left and time.time() < until:
        time.sleep(0.2)
        left &= shuffle_files(spark)
    assert not left
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert table.count() == df.count() == 1000  # the frame itself can be run again
    assert sorted(table.collect()) == sorted(df.collect())
