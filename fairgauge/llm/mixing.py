"""Mixing sources to target weights by a time-varying curriculum (operator 6).

A source's target is its share of the mix by weight, stopped at ``cap`` times its own
words, the excess going to the others by weight (water filling). Its weight schedule,
a piecewise linear rate over training time 0 ... 1, is integrated to a cumulative
demand that reaches the target at time 1. The source's documents stand in a fixed
pseudo-random order, one pass after the other; a copy that covers the words a ... b of
that sequence is due when the demand reaches its middle, so its training position is
the inverse of the cumulative demand there. Words beyond the target aren't taken: the
copy at the end of the demand is taken in part. Copies are range-sorted by position.

Running sums need no source in one task: documents are summed per source and bucket of
the order, the few bucket sums are summed again, and a window runs inside each bucket.

Defined cases: a null text has 0 words; sources are ordered by code point, null last as
a source of its own; rows of equal id and text follow each other; a source without
words has target 0; an empty table gives an empty result; extra columns are carried.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairgauge.llm.common import WORD_PATTERN

#: Parts of a source's order that are summed on their own.
BUCKETS = 1024
WEIGHTS = (3, 1, 2)


@dataclass(frozen=True)
class Schedule:
    """Rate of a source over training time: linear between (time, rate) knots."""

    knots: tuple[tuple[float, float], ...] = ((0.0, 1.0), (1.0, 1.0))

    def areas(self) -> list[float]:
        out = [0.0]
        for (t, r), (u, q) in zip(self.knots, self.knots[1:], strict=False):
            out.append(out[-1] + (u - t) * (r + q) / 2)
        return out

    def time_of(self, share: Column) -> Column:
        """The time at which the demand has reached ``share`` of its whole."""
        areas, pieces = self.areas(), list(zip(self.knots, self.knots[1:], strict=False))
        out = F.lit(self.knots[-1][0])
        for k in range(len(pieces) - 1, -1, -1):
            (t, r), (u, q) = pieces[k]
            area = F.least(share * areas[-1], F.lit(areas[k + 1])) - areas[k]
            slope = (q - r) / (u - t)
            inside = (F.sqrt(r * r + 2 * slope * area) - r) / slope if slope else area / r if r else area * 0
            out = F.when(share * areas[-1] <= areas[k + 1], t + inside).otherwise(out)
        return out


#: Of the sources in turn: an early one fades, a late one rises, one stays.
SCHEDULES = (
    Schedule(((0.0, 1.5), (1.0, 0.5))),
    Schedule(((0.0, 0.5), (0.5, 0.5), (1.0, 2.0))),
    Schedule(),
)


def _keyed(docs: DataFrame, id_col: str, carried: list[str]) -> DataFrame:
    """Size, source and place in the order of each document."""
    text = F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.md5(text)))
    return docs.select(
        F.col(id_col).alias("id"),
        *carried,
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")).alias("source_key"),
        key.alias("place"),
    ).withColumn("bucket", (F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * BUCKETS / 2**32).cast("int"))


def targets(sizes: DataFrame, weights: Sequence[float], total: float, cap: float) -> DataFrame:
    """source_key, source_size, source_rank and target, of a row per source with its
    ``source_size``; the windows hold that small table, never documents."""
    null_last = F.when(F.col("source_key") == "null", 1).otherwise(0)
    ranked = sizes.withColumn("source_rank", F.row_number().over(Window.orderBy(null_last, "source_key")) - 1)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("source_rank") % len(weights))
    by_ratio = Window.orderBy("ratio", "source_rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        F.lit(total) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = (
        ranked.withColumn("weight", weight)
        .withColumn("most", F.lit(cap) * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumns({"level": level, "fill_rank": F.row_number().over(by_ratio)})
        .withColumn(
            "first_open",
            F.min(F.when(F.col("ratio") > F.col("level"), F.struct("fill_rank", "level"))).over(everything),
        )
    )
    target = F.when(
        F.col("fill_rank") >= F.col("first_open.fill_rank"), F.col("first_open.level") * F.col("weight")
    ).otherwise(F.col("most"))
    return filled.select("source_key", "source_size", "source_rank", target.alias("target"))


def _planned(
    docs: DataFrame, id_col: str, carried: list[str], weights: Sequence[float], total: float, cap: float,
    schedules: Sequence[Schedule],
) -> DataFrame:
    """Each document with its source's target and ``copies``: an array of (taken words,
    whole copy due, position), one for each pass over the source."""
    sums = _keyed(docs.select(id_col, "text", "source"), id_col, []).groupBy("source_key", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sums.withColumn("bucket_start", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")))
    wanted = targets(sums.groupBy("source_key").agg(F.sum("n").alias("source_size")), weights, total, cap)
    places = buckets.drop("n").join(wanted, "source_key")
    inside = Window.partitionBy("source_key", "bucket").orderBy("place", "id").rowsBetween(Window.unboundedPreceding, -1)
    rows = _keyed(docs, id_col, carried).withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))
    placed = rows.join(places, ["source_key", "bucket"]).withColumn("start", F.col("bucket_start") + F.col("before"))
    due = F.floor("target")
    copies = []
    for k in range(-int(-cap // 1)):
        start = F.col("start") + k * F.col("source_size")
        taken = F.greatest(F.lit(0).cast("long"), F.least(due, start + F.col("size")) - start)
        share = F.when(F.col("target") > 0, F.least(F.lit(1.0), (start + taken / 2) / F.col("target"))).otherwise(0.0)
        time = schedules[0].time_of(share)
        for j, schedule in enumerate(schedules[1:], 1):
            time = F.when(F.col("source_rank") % len(schedules) == j, schedule.time_of(share)).otherwise(time)
        whole = start + F.col("size") / 2 <= F.col("target")
        copies.append(F.struct(taken.alias("taken"), whole.alias("whole"), time.alias("position")))
    return placed.withColumn("copies", F.array(*copies))


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", weights: Sequence[float] = WEIGHTS, total: float = 1.5, cap: float = 2.0,
    schedules: Sequence[Schedule] = SCHEDULES,
) -> DataFrame:
    """A row per document, range-sorted by the position of its first copy: ``id_col``,
    size, source_size, target, taken, position (null: not taken), later_positions."""
    planned = _planned(docs.select(id_col, "text", "source"), id_col, [], weights, total, cap, schedules)
    used = F.transform(F.filter("copies", lambda c: c["taken"] > 0), lambda c: c["position"])
    return planned.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["taken"]).alias("taken"),
        F.get(used, F.lit(0)).alias("position"),
        F.slice(used, 2, 1 << 30).alias("later_positions"),
    ).orderBy(F.col("position").asc_nulls_last(), id_col)


def mix_documents(
    docs: DataFrame, id_col: str = "doc_id", weights: Sequence[float] = WEIGHTS, total: float = 1.5, cap: float = 2.0,
    schedules: Sequence[Schedule] = SCHEDULES,
) -> DataFrame:
    """The mix itself: ``docs`` in their own columns, a row for each whole copy whose
    middle the demand reaches, range-sorted by position."""
    rows = docs.select(id_col, "text", "source", F.struct("*").alias("row"))
    planned = _planned(rows, id_col, ["row"], weights, total, cap, schedules)
    copies = planned.select("row", F.explode(F.filter("copies", lambda c: c["whole"] & (F.col("size") > 0))).alias("copy"))
    return (
        copies.select("row", F.col("copy.position").alias("position"))
        .repartitionByRange("position")
        .sortWithinPartitions("position")
        .select("row.*")
    )
