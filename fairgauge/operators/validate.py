"""Score validation, VA-1 and VA-2. No row is ever dropped: invalid and
unparsed rows stay in the output, flagged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairgauge.plans.strategies import PRINCIPLES


def in_range(score: Column, max_score: int) -> Column:
    """``x is not None and 0 <= x <= max`` — NULL counts as False."""
    return F.coalesce(score.between(0, max_score), F.lit(False))


def valid_a(df: DataFrame) -> DataFrame:
    """VA-1: one flag; False unless parsed and all four scores in range."""
    ok = F.col("parse_ok")
    for _, letter, mx in PRINCIPLES:
        ok = ok & in_range(F.col(f"{letter}_score"), mx)
    return df.withColumn("valid_scores", F.coalesce(ok, F.lit(False)))


def valid_b(df: DataFrame) -> DataFrame:
    """VA-2: a flag per principle and ``all_valid``, their AND."""
    flags = []
    for _, letter, mx in PRINCIPLES:
        df = df.withColumn(f"{letter}_valid", in_range(F.col(f"{letter}_score"), mx))
        flags.append(F.col(f"{letter}_valid"))
    all_valid = flags[0]
    for f in flags[1:]:
        all_valid = all_valid & f
    return df.withColumn("all_valid", all_valid)
