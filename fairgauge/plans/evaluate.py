"""The batch job, in two halves around the external scoring step.

    catalogue ─┐
               ├─ JOIN-1 ─ fan-out ─ prompts ─▶ requests table (written)
    pages ─ extract ┘                                   │
                                   replies table ◀── (scoring elsewhere)
    requests table ⟕ replies ─ parse ─ validate ─▶ results (written)

The requests table is written before any reply exists: replies are not
reproducible, so nothing upstream of them may be recomputed lazily, and the
content-addressed ``request_id`` ties each reply to exactly one prompt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairgauge.operators.extract import fill_error_record
from fairgauge.operators.joins import attach_pages, attach_replies, fan_out
from fairgauge.operators.prompts import request_lines, with_requests
from fairgauge.operators.results import (
    DISPLAY_A, DISPLAY_B, result_a, result_b, unified, write_csv,
)
from fairgauge.plans.strategies import strategies as strategy_rows
from fairgauge.sources.catalog import bad_records, catalog_records, keyed, named
from fairgauge.sources.pages import read_pages
from fairgauge.sources.replies import read_replies
from fairgauge.sources.requests import BUCKETS, add_keys, not_asked, open_keys, read_table
from fairgauge.streaming.replies import latest_scores

#: Columns of the written requests table that the results half reads back.
REQUEST_COLUMNS = (
    "request_id", "strategy", "dialect", "row_id", "dataset_name", "website_link",
    "title", "description", "license_info", "file_formats", "download_links",
    "raw_text_snippet", "scrape_ok", "scrape_error", "system_content", "user_content", "max_tokens",
)


def scraped_catalog(catalog: DataFrame, pages: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Catalogue rows with their page's extracted record (JOIN-1)."""
    return attach_pages(keyed(catalog), pages, hot_rows)


def requests(
    catalog: DataFrame,
    pages: DataFrame,
    strategy_names: list[str] | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Requests for every (catalogue row, strategy): MAP-2, EX-9, PR-*."""
    strats = strategy_rows(strategy_names)
    fanned = fan_out(scraped_catalog(catalog, pages, hot_rows), strats)
    filled = fill_error_record(fanned, F.col("dialect"))
    return with_requests(filled, strats).select(*REQUEST_COLUMNS)


def results(requests_table: DataFrame, replies: DataFrame, buckets: int | None = None) -> DataFrame:
    """OUT-U from the written requests and the replies (JOIN-2, PA-*, VA-*). ``buckets``:
    the requests are bucketed so by ``request_id``."""
    narrow = requests_table.select(
        "request_id", "strategy", "dialect", "row_id", "dataset_name", "website_link",
        "title", "license_info", "file_formats", "scrape_error",
    )
    return unified(attach_replies(narrow, replies, buckets))


def write_requests(
    spark: SparkSession,
    catalog_csv: str,
    pages_path: str,
    out_dir: str,
    strategy_names: list[str] | None = None,
    hot_rows: int | None = None,
    run: str = "first",
    key_column: str | None = None,
    buckets: int = BUCKETS,
) -> str:
    """First half: a run's new requests, as parquet and as the JSON lines a scoring service
    consumes. Returns the path of the requests of all runs.

    Tables below ``out_dir``, a directory ``run=<run>`` each: ``catalog`` (good records),
    ``catalog_bad`` (the others, with their problem), ``requests``, ``request_lines``; and
    ``requests_keys``, bucketed for JOIN-2. A later run asks only what no earlier one has
    asked: its requests are written to ``requests_drawn`` first, as most of them then fall
    out. Rows are told apart by their number in the catalogue, so a catalogue that grows
    elsewhere than at its end should name a ``key_column``.

    The requests aren't partitioned by strategy: a partitioned write sorts each task's
    output by the partition column, and here that output is four prompts of several KB per
    catalogue row. Readers prune columns instead."""
    # Replies refer to these tables and can't be had again: none is ever overwritten.
    def kept(df: DataFrame, name: str) -> DataFrame:
        path = f"{out_dir}/{name}/run={run}"
        df.write.mode("errorifexists").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    table = f"{out_dir}/requests"
    asked = read_table(spark, table)
    rows = catalog_records(spark, catalog_csv)
    catalog = kept(named(rows, key_column), "catalog")
    kept(bad_records(rows), "catalog_bad")
    drawn = requests(catalog, read_pages(spark, pages_path), strategy_names, hot_rows)
    new = drawn if asked is None else not_asked(kept(drawn, "requests_drawn"), asked)
    written = kept(new, "requests")
    request_lines(written).write.mode("errorifexists").text(f"{out_dir}/request_lines/run={run}")
    add_keys(written.withColumn("run", F.lit(run)), f"{table}_keys", buckets)
    return table


def write_results(spark: SparkSession, requests_path: str, replies_path: str, out_dir: str) -> str:
    """Second half: join the replies, parse, validate, write parquet (by
    strategy) plus one CSV per strategy in its script's own columns, in the catalogue's
    order (a range-partitioned sort by ``row_id``). Returns the parquet path."""
    keys, buckets = open_keys(spark, f"{requests_path}_keys")
    out = results(keys, read_replies(spark, replies_path), buckets)
    table = f"{out_dir}/results"
    out.write.mode("overwrite").partitionBy("strategy").parquet(table)
    write_strategy_csvs(spark.read.parquet(table), out_dir)
    return table


def streamed_results(spark: SparkSession, requests_path: str, scored_path: str) -> DataFrame:
    """OUT-U from the requests and what the reply stream has scored so far
    (:mod:`fairgauge.streaming.replies`): no reply is parsed again."""
    keys, buckets = open_keys(spark, f"{requests_path}_keys")
    best = latest_scores(spark.read.parquet(scored_path), buckets)
    narrow = keys.select(
        "request_id", "strategy", "dialect", "row_id", "dataset_name", "website_link",
        "title", "license_info", "file_formats", "scrape_error",
    )
    joined = narrow.join(best, "request_id", "left")
    return unified(joined.withColumn("reply_count", F.coalesce("reply_count", F.lit(0).cast("bigint"))))


def write_strategy_csvs(written: DataFrame, out_dir: str) -> None:
    """SNK-1: ``results_<strategy>_csv`` for each strategy."""
    for s in strategy_rows():
        rows, display = (result_a(written), DISPLAY_A) if s["dialect"] == "A" else (result_b(written), DISPLAY_B)
        ordered = rows.where(F.col("strategy") == s["strategy"]).orderBy("row_id").drop("strategy", "row_id")
        write_csv(ordered, f"{out_dir}/results_{s['strategy']}_csv", display)
