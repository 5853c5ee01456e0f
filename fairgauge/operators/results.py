"""Result tables: OUT-A, OUT-B, OUT-U, the CSV export SNK-1, and the
derived tables DER-1 … DER-3.

Internal names are snake_case; the scripts' display names are applied only
when a CSV is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairgauge.functions.text import py_list_repr
from fairgauge.operators.parse import multi_row_reply
from fairgauge.operators.validate import valid_a, valid_b
from fairgauge.plans.strategies import PRINCIPLES
from fairgauge.scratch import materialise

#: Quotes doubled, white space at the ends of cells kept.
CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

#: Maximum total score (sum of the principle maxima) — bounds DER-3's histogram.
MAX_TOTAL = sum(m for _, _, m in PRINCIPLES)

# The scripts' output column names, in their order.
DISPLAY_A = {
    "dataset_name": "Dataset Name",
    "website_link": "Website Link",
    "fair_raw_output": "FAIR Raw Output",
    "scraped_title": "Scraped Title",
    "scraped_license": "Scraped License",
    "scraped_file_formats": "Scraped File Formats",
    "parse_success": "Parse Success",
    "valid_scores": "Valid Scores",
    "parsed_dataset_name": "Parsed Dataset Name",
    "f_score": "F-Score",
    "a_score": "A-Score",
    "i_score": "I-Score",
    "r_score": "R-Score",
}
DISPLAY_B = {
    "dataset_name": "Dataset Name",
    "website_link": "Website Link",
    "fair_raw_output": "FAIR Evaluation Raw Output",
    "scraped_title": "Scraped Title",
    "scraped_license": "Scraped License",
    "scraped_file_formats": "Scraped File Formats",
    "parsed_dataset_name": "Dataset Name (Parsed)",
    "f_score": "F-Score",
    "a_score": "A-Score",
    "i_score": "I-Score",
    "r_score": "R-Score",
    "f_valid": "F-Score Valid",
    "a_valid": "A-Score Valid",
    "i_valid": "I-Score Valid",
    "r_valid": "R-Score Valid",
    "all_valid": "All Valid",
}


def unified(answered: DataFrame) -> DataFrame:
    """OUT-U: one row per request with its dialect's parse and both kinds of
    validity flags. ``answered`` is the requests table joined to parsed replies."""
    checked = valid_b(valid_a(answered))
    return checked.select(
        "strategy", "dialect", "row_id", "request_id",
        "dataset_name", "website_link",
        F.col("response").alias("fair_raw_output"),
        F.col("title").alias("scraped_title"),
        F.col("license_info").alias("scraped_license"),
        F.col("file_formats").alias("scraped_file_formats"),
        "scrape_error",
        F.coalesce("parse_ok", F.lit(False)).alias("parse_success"),
        "valid_scores", "parsed_dataset_name",
        "f_score", "a_score", "i_score", "r_score",
        "f_valid", "a_valid", "i_valid", "r_valid", "all_valid",
        multi_row_reply(F.col("response")).alias("multi_row_reply"), "reply_count",
    )


def result_a(u: DataFrame) -> DataFrame:
    """OUT-A: the zero-shot table; formats joined by ', '."""
    cols = [
        F.array_join("scraped_file_formats", ", ").alias(c) if c == "scraped_file_formats" else F.col(c)
        for c in DISPLAY_A
    ]
    return u.where(F.col("dialect") == "A").select("strategy", "row_id", *cols)


def result_b(u: DataFrame) -> DataFrame:
    """OUT-B: the one-/few-shot table; formats are a list, written as the
    text Python prints for it."""
    cols = [
        py_list_repr(F.col(c)).alias(c) if c == "scraped_file_formats" else F.col(c)
        for c in DISPLAY_B
    ]
    return u.where(F.col("dialect") == "B").select("strategy", "row_id", *cols)


def write_csv(df: DataFrame, path: str, display: dict[str, str]) -> None:
    """SNK-1: CSV with the scripts' headers. Quotes doubled, whitespace and
    newlines inside replies kept."""
    out = df.select(*[F.col(c).alias(display.get(c, c)) for c in df.columns])
    (
        out.write.mode("overwrite")
        .option("header", True)
        .options(**CSV_OPTIONS)
        .csv(path)
    )


def component_scores(u: DataFrame) -> DataFrame:
    """DER-1: scores in long form, one row per (request, principle)."""
    long = u.select(
        "strategy", "row_id",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("principle"),
                        F.col(f"{letter}_score").alias("score"),
                        F.lit(mx).alias("max_score"),
                        F.col(f"{letter}_valid").alias("valid"),
                    )
                    for name, letter, mx in PRINCIPLES
                ]
            )
        ),
    )
    return long


def strategy_summary(u: DataFrame) -> DataFrame:
    """DER-2: per strategy — rows, parsed, valid, and the mean of each
    principle over valid rows. Partial aggregation keeps the shuffle at one
    row per strategy per map task."""
    v = F.col("all_valid")
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("parse_success").cast("bigint")).alias("n_parsed"),
        F.sum(v.cast("bigint")).alias("n_valid"),
    ]
    for _, letter, _ in PRINCIPLES:
        aggs.append(F.round(F.avg(F.when(v, F.col(f"{letter}_score"))), 4).alias(f"mean_{letter}"))
    return u.groupBy("strategy").agg(*aggs)


def dataset_ranking(u: DataFrame) -> DataFrame:
    """DER-3: rank of each valid row within its strategy by total score
    (SQL ``rank``: ties share a rank).

    A window partitioned by strategy would put a whole strategy in one
    task. Instead the rank comes from a histogram of totals: valid totals lie
    in 0..MAX_TOTAL, so the histogram has at most strategies × 43 rows — a
    proven bound — and is broadcast back to the rows. Histogram and rows are read
    from one written table of the valid rows' totals.
    """
    totals = u.where(F.col("all_valid")).select(
        "strategy", "row_id", "dataset_name",
        (F.col("f_score") + F.col("a_score") + F.col("i_score") + F.col("r_score")).alias("total_score"),
    )
    valid = materialise(totals, "valid_totals")
    hist = valid.groupBy("strategy", "total_score").agg(F.count(F.lit(1)).alias("_n"))
    above = Window.partitionBy("strategy").orderBy(F.desc("total_score")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranks = hist.select(
        "strategy", "total_score",
        (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias("rank"),
    )
    return valid.join(F.broadcast(ranks), ["strategy", "total_score"], "inner")
