"""DER-4 … DER-6: how far the strategies agree about the same datasets.

Everything is computed from a contingency table of score pairs: for two strategies and a
measure (the total or a principle) it has a row per pair of scores, at most 43 x 43 of
them however many datasets were scored. Building it is the only pass over the results: as
each statistic reads it several times, it is written first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairgauge.operators.results import MAX_TOTAL
from fairgauge.plans.strategies import PRINCIPLES
from fairgauge.scratch import materialise

#: Measures with their largest score.
MEASURES = {"Total": MAX_TOTAL, **{name: largest for name, _, largest in PRINCIPLES}}
KEYS = ["strategy_a", "strategy_b", "measure"]


def _ratio(over: Column, under: Column) -> Column:
    return F.round(over / F.when(under > 0, under), 6)


def score_pairs(u: DataFrame) -> DataFrame:
    """DER-4: ``n`` datasets to which ``strategy_a`` gave ``score_a`` and ``strategy_b``,
    behind it by name, ``score_b``; rows that aren't valid under both are left out. A
    dataset's rows meet once, one per strategy, and counting is combined before it is
    shuffled."""
    parts = [F.col(f"{letter}_score") for _, letter, _ in PRINCIPLES]
    scores = F.array(sum(parts[1:], parts[0]), *parts)
    judged = (
        u.where(F.col("all_valid"))
        .select("row_id", F.struct("strategy", scores.alias("scores")).alias("judged"))
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_list("judged")).alias("judged"))
    )
    behind = lambda at: F.slice("judged", at + 2, F.size("judged"))
    pairs = F.transform("judged", lambda a, at: F.transform(behind(at), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    two = judged.select(F.explode(F.flatten(pairs)).alias("two")).select("two.*")
    by_measure = F.array(
        *[
            F.struct(F.lit(m).alias("measure"), F.col("a.scores")[i].alias("score_a"), F.col("b.scores")[i].alias("score_b"))
            for i, m in enumerate(MEASURES)
        ]
    )
    long = two.select(F.col("a.strategy").alias("strategy_a"), F.col("b.strategy").alias("strategy_b"), F.inline(by_measure))
    return long.groupBy(*KEYS, "score_a", "score_b").agg(F.count("*").alias("n"))


def agreement(pairs: DataFrame) -> DataFrame:
    """DER-5: share of equal scores, mean difference, and Cohen's kappa with linear and
    with quadratic weights; a kappa is NULL where chance alone leaves no disagreement.

    The linear disagreement expected by chance is a sum over thresholds t of the pairs that
    t parts: with F and G the two strategies' counts up to t, F (n - G) + G (n - F). Prefix
    sums over the scores that occur give F and G, the next score tells how long they hold."""
    pairs = materialise(pairs, "score_pairs")
    n, a, b = (F.col(c).cast("double") for c in ("n", "score_a", "score_b"))
    sums = pairs.groupBy(*KEYS).agg(
        F.sum("n").alias("n"),
        F.sum(n).alias("rows"),
        F.sum(F.when(F.col("score_a") == F.col("score_b"), n).otherwise(0.0)).alias("equal"),
        F.sum(n * a).alias("sum_a"),
        F.sum(n * b).alias("sum_b"),
        F.sum(n * (a * a + b * b)).alias("squares"),
        F.sum(n * F.abs(a - b)).alias("apart"),
        F.sum(n * (a - b) * (a - b)).alias("apart_2"),
    )
    one = lambda score, f, g: F.struct(F.col(score).alias("t"), f.alias("f"), g.alias("g"))
    sides = F.array(one("score_a", n, F.lit(0.0)), one("score_b", F.lit(0.0), n))
    edges = pairs.select(*KEYS, F.inline(sides)).groupBy(*KEYS, "t").agg(F.sum("f").alias("f"), F.sum("g").alias("g"))
    order = Window.partitionBy(*KEYS).orderBy("t")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    cdf = edges.select(
        *KEYS, F.sum("f").over(upto).alias("f"), F.sum("g").over(upto).alias("g"), (F.lead("t").over(order) - F.col("t")).alias("width")
    )
    parted = F.col("f") * (F.col("rows") - F.col("g")) + F.col("g") * (F.col("rows") - F.col("f"))
    chance = cdf.join(sums.select(*KEYS, "rows"), KEYS).groupBy(*KEYS).agg(F.sum(F.col("width") * parted).alias("chance"))
    rows, linear = F.col("rows"), F.coalesce("chance", F.lit(0.0))
    quadratic = rows * F.col("squares") - 2 * F.col("sum_a") * F.col("sum_b")
    return sums.join(chance, KEYS).select(
        *KEYS,
        "n",
        _ratio(F.col("equal"), rows).alias("equal_share"),
        _ratio(F.col("sum_a") - F.col("sum_b"), rows).alias("mean_difference"),
        _ratio(linear - rows * F.col("apart"), linear).alias("kappa_linear"),
        _ratio(quadratic - rows * F.col("apart_2"), quadratic).alias("kappa_quadratic"),
    )


def rank_correlation(pairs: DataFrame) -> DataFrame:
    """DER-6: pairs of datasets that two strategies put in the same order and in opposite
    ones, and Kendall's tau-b (NULL where a strategy gives one score only).

    No two datasets are compared: prefix sums over the whole grid of scores, first along b
    and then along a, count for each cell the datasets below it in both scores."""
    pairs = materialise(pairs, "score_pairs")
    largest = F.element_at(F.create_map(*[F.lit(x) for item in MEASURES.items() for x in item]), F.col("measure"))
    grid = (
        pairs.select(*KEYS)
        .distinct()
        .withColumn("score_a", F.explode(F.sequence(F.lit(0), largest)))
        .withColumn("score_b", F.explode(F.sequence(F.lit(0), largest)))
    )
    cells = grid.join(pairs, [*KEYS, "score_a", "score_b"], "left").withColumn("m", F.coalesce(F.col("n").cast("double"), F.lit(0.0)))
    along_b = Window.partitionBy(*KEYS, "score_a").orderBy("score_b")
    along_a = Window.partitionBy(*KEYS, "score_b").orderBy("score_a")
    row = cells.withColumn("row", F.sum("m").over(along_b.rowsBetween(Window.unboundedPreceding, 0)))
    # Datasets of a smaller score_a, and a score_b of at most this one.
    upto = row.withColumn("upto", F.coalesce(F.sum("row").over(along_a.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    placed = upto.withColumn("below", F.lag("upto", 1, 0.0).over(along_b)).withColumn(
        "smaller", F.max("upto").over(Window.partitionBy(*KEYS, "score_a"))
    )
    orders = placed.groupBy(*KEYS).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("m") * F.col("below")).alias("concordant"),
        F.sum(F.col("m") * (F.col("smaller") - F.col("upto"))).alias("discordant"),
    )
    ties = None
    for side in "ab":
        m = F.col("m")
        tied = (
            pairs.groupBy(*KEYS, f"score_{side}")
            .agg(F.sum(F.col("n").cast("double")).alias("m"))
            .groupBy(*KEYS)
            .agg(F.sum(m * (m - 1) / 2).alias(f"ties_{side}"))
        )
        ties = tied if ties is None else ties.join(tied, KEYS)
    every = F.col("n").cast("double") * (F.col("n") - 1) / 2
    spread = F.sqrt((every - F.col("ties_a")) * (every - F.col("ties_b")))
    return orders.join(ties, KEYS).select(
        *KEYS, "n", "concordant", "discordant", _ratio(F.col("concordant") - F.col("discordant"), spread).alias("tau_b")
    )
