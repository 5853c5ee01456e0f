"""Exact dedup by content sort (operator 9, DataFrame functions only).

Sampled splitters range-partition the normalised bytes, each partition is sorted
externally so that equal texts become neighbours, and neighbours are compared in
full. The splitters are drawn over (leading characters, SHA-256, salt) instead of
the texts, so that the sample the driver sees has a bounded size per row and a
group that holds a third of all rows is cut over many partitions; a salted run
leaves one summary row, and runs of one text are joined by those.

Defined cases: a null text counts as empty; texts are equal when identical after
lower-casing A-Z; of equal texts the row with the largest (or smallest) id stays;
of rows that share that id exactly one stays; null ids lose against all others; an
empty table gives an empty result; other columns are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairgauge.llm.common import ascii_lower, materialise

#: Leading characters in a splitter, and the parts that a text's copies are dealt to.
LEAD_CHARS = 32
SALTS = 64


def _sorted_runs(rows: DataFrame, id_col: str, carried: list[str], largest: bool) -> DataFrame:
    """Each row with its digest, salt and rank among its salted run's copies. Where whole
    rows are carried, their text is normalised behind the exchange, to be moved once."""
    def normal(text: str) -> Column:
        return F.coalesce(ascii_lower(F.col(text)), F.lit(""))

    keyed = rows.withColumn("norm", normal("text")).select(
        F.col(id_col).alias("id"),
        *carried,
        *([] if carried else ["norm"]),
        F.substring("norm", 1, LEAD_CHARS).alias("lead"),
        F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int").alias("salt"),
    )
    run = Window.partitionBy("lead", "digest", "salt").orderBy(
        "norm", F.col("id").desc_nulls_last() if largest else F.col("id").asc_nulls_last()
    )
    rank, before = F.row_number().over(run), F.lag("norm").over(run)
    dealt = keyed.repartitionByRange("lead", "digest", "salt")
    return (
        (dealt.withColumn("norm", normal("row.text")) if carried else dealt)
        .withColumns({"rank": rank, "before": before})
        .select(
            "id",
            *carried,
            "digest",
            "salt",
            F.when((F.col("rank") == 1) | (F.col("norm") == F.col("before")), F.col("rank"))
            .otherwise(F.raise_error(F.lit("two texts with one SHA-256")))
            .alias("rank"),
        )
    )


def _totals(runs: DataFrame, largest: bool) -> DataFrame:
    """Per digest and salt: size and survivor of the whole group."""
    best = F.max if largest else F.min
    whole = Window.partitionBy("digest")
    return (
        runs.groupBy("digest", "salt")
        .agg(F.count("*").alias("n"), best("id").alias("best"))
        .select(
            "digest",
            "salt",
            F.sum("n").over(whole).alias("group_size"),
            best("best").over(whole).alias("keep_id"),
        )
    )


def _kept() -> Column:
    return F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("rank") == 1)


def group_copies(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256."""
    largest = keep == "largest"
    runs = materialise(_sorted_runs(docs.select(id_col, "text"), id_col, [], largest), "content-runs")
    return runs.join(_totals(runs, largest), ["digest", "salt"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        _kept().alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of equal texts, in the same columns."""
    largest = keep == "largest"
    rows = docs.select(id_col, "text", F.struct("*").alias("row"))
    runs = materialise(
        _sorted_runs(rows, id_col, ["row"], largest).where(F.col("rank") == 1), "content-survivors"
    )
    best = _totals(runs.drop("row"), largest).drop("group_size")
    return runs.join(best, ["digest", "salt"]).where(_kept()).select("row.*")
