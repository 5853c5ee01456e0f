"""Helpers shared by the operators: scratch tables, ASCII folding, words."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairgauge.scratch import drop_scratch, materialise, noted_scratch, scratch_path, scratch_root  # noqa: F401

#: A word, wherever an operator counts words: a run without ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z only; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def number_rows(df: DataFrame, order: list[Column], name: str, within: str | None = None) -> DataFrame:
    """``df`` with ``name``: each row's place from 0 in ``order``, among the rows of its
    ``within``. Rows are range-sorted and written once with their place in their partition;
    the partitions' sizes are summed on their own, so no group meets in one task. Equal rows
    are dealt to several partitions, too."""
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*([F.col(within)] if within else []), *order, F.col("_tie")]
    placed = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    rows = materialise(placed.withColumn("_part", F.shiftright("_at", 33)).drop("_tie"), "numbered")
    group = [within] if within else []
    sizes = rows.groupBy("_part", *group).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("long"))).drop("_n")
    return rows.join(starts, ["_part", *group]).withColumn(name, F.col("_at") - F.col("_first") + F.col("_start")).drop(
        "_part", "_at", "_first", "_start"
    )
