"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairgauge.llm.common import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of an edge. Large-star
    and small-star in turn: each node's larger, then its smaller neighbours are tied to
    its smallest one, until every component is a star. Each round's edges are written, so
    a lost executor costs one round; the number of rounds grows with the logarithm of the
    largest component's size."""
    now = materialise(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct(), "components"
    )
    seen = _state(now)
    while seen[0]:
        both = _both_ways(now)
        lowest = both.groupBy("a").agg(F.min("b").alias("low"))
        large = (
            both.join(lowest, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("low", "a").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
            .select("e.*")
            .where("a > b")
            .distinct()
        )
        now = materialise(small, "components")
        before, seen = seen, _state(now)
        if before == seen:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
