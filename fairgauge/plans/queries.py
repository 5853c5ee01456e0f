"""The registered queries: one per operator group of the survey's inventory.

Each takes ``(spark, sf_dir)``, reads the driver's tables (through the
fixtures of :mod:`fairgauge.plans.fixtures`) and returns a DataFrame with
flat columns — arrays joined to text — named as in :mod:`.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairgauge.operators import agreement as A
from fairgauge.operators import results as R
from fairgauge.operators.extract import fill_error_record, visible_text
from fairgauge.operators.joins import attach_pages, attach_replies, fan_out
from fairgauge.operators.parse import parsed_as
from fairgauge.operators.prompts import envelope, request_lines, with_requests
from fairgauge.operators.validate import valid_a, valid_b
from fairgauge.plans import fixtures as X
from fairgauge.plans.strategies import strategies
from fairgauge.scratch import materialise
from fairgauge.sources.catalog import CSV_OPTIONS, bad_records, keyed, named
from fairgauge.sources.pages import extract_pages
from fairgauge.sources.records import records, with_cells
from fairgauge.sources.replies import normalise_replies

SEP = " || "


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return X.overlay_pages(X.load(spark, sf, "pages"))


def _extracted(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pages(_pages(spark, sf))


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    pages = X.load(spark, sf, "pages")
    return X.catalog_fixture(pages, X.load(spark, sf, "nation"), X.load(spark, sf, "region"))


def joined_catalog(spark: SparkSession, sf: str, page_tasks: int | None = None) -> DataFrame:
    return attach_pages(keyed(_catalog(spark, sf)), _pages(spark, sf), page_tasks=page_tasks)


def request_table(spark: SparkSession, sf: str, page_tasks: int | None = None) -> DataFrame:
    strats = strategies()
    fanned = fan_out(joined_catalog(spark, sf, page_tasks), strats)
    return with_requests(fill_error_record(fanned, F.col("dialect")), strats)


def unified_results(spark: SparkSession, sf: str) -> DataFrame:
    """As in the job, requests are written before replies are made for them: both sides of
    JOIN-2 read their columns, and pages are extracted and prompts built once."""
    reqs = request_table(spark, sf).select(
        "request_id", "strategy", "dialect", "row_id", "dataset_name", "website_link",
        "title", "license_info", "file_formats", "scrape_error",
    )
    written = materialise(reqs, "requests")
    return R.unified(attach_replies(written, X.reply_stub(written)))


def _page_field(field: str, expr=None) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        col = F.col(field) if expr is None else expr(F.col(field))
        return _extracted(spark, sf).select("page_id", "scrape_error", col.alias(field))

    return q


def extract_text(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).select("page_id", visible_text(F.col("html")).alias("text"))


def _record(dialect: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        filled = fill_error_record(joined_catalog(spark, sf), F.lit(dialect))
        return filled.select(
            "row_id", "dataset_name", "title", "description", "license_info",
            F.array_join("file_formats", SEP).alias("file_formats"),
            F.array_join("download_links", SEP).alias("download_links"),
            "raw_text_snippet", "scrape_ok", "scrape_error",
        )

    return q


def catalog_join(spark: SparkSession, sf: str) -> DataFrame:
    return joined_catalog(spark, sf).select("row_id", "dataset_name", "website_link", "url_key", "page_id", "scrape_error")


def strategy_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return fan_out(joined_catalog(spark, sf), strategies()).select("row_id", "strategy", "dialect")


def _prompt(dialect: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return request_table(spark, sf).where(F.col("dialect") == dialect).select(
            "row_id", "strategy",
            F.md5("user_content").alias("content_md5"),
            F.length("user_content").cast("bigint").alias("content_chars"),
        )

    return q


def request_envelope(spark: SparkSession, sf: str) -> DataFrame:
    env = envelope(request_table(spark, sf))
    msgs = F.col("request.messages")
    return env.select(
        "request_id", "strategy", "row_id",
        F.col("request.model").alias("model"),
        F.col("request.temperature").alias("temperature"),
        F.col("request.max_tokens").alias("max_tokens"),
        F.md5(msgs[0]["content"]).alias("system_md5"),
        F.md5(msgs[1]["content"]).alias("user_md5"),
    )


def _parse(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        replies = X.turn_replies(X.load(spark, sf, "conversations"))
        return parsed_as(replies, kind).drop("response")

    return q


def _validate(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    parse = _parse(kind)

    def q(spark: SparkSession, sf: str) -> DataFrame:
        checked = valid_b(valid_a(parse(spark, sf)))
        return checked.select(
            "conv_id", "turn", "parse_ok", "f_score", "a_score", "i_score", "r_score",
            "valid_scores", "f_valid", "a_valid", "i_valid", "r_valid", "all_valid",
        )

    return q


def reply_source(spark: SparkSession, sf: str) -> DataFrame:
    bodies = X.completion_bodies(X.turn_replies(X.load(spark, sf, "conversations")))
    keyed_bodies = bodies.select(F.concat_ws("-", "conv_id", "turn").alias("request_id"), "body")
    return normalise_replies(keyed_bodies)


def request_json(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2: the written JSON lines, read back field by field."""
    messages = "messages array<struct<role:string,content:string>>"
    schema = f"request_id string, strategy string, row_id long, request struct<model:string,{messages.replace(' ', ':', 1)},temperature:double,max_tokens:int>"
    line = F.from_json("value", schema)
    body = line["request"]
    return request_lines(request_table(spark, sf)).select(
        line["request_id"].alias("request_id"), line["strategy"].alias("strategy"), line["row_id"].alias("row_id"),
        body["model"].alias("model"), body["temperature"].alias("temperature"), body["max_tokens"].alias("max_tokens"),
        body["messages"][0]["role"].alias("first_role"), body["messages"][1]["role"].alias("second_role"),
        F.md5(body["messages"][0]["content"]).alias("system_md5"), F.md5(body["messages"][1]["content"]).alias("user_md5"),
    )


def result_csv_line(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1: each zero-shot row as the CSV text that the sink writes for it."""
    rows = R.result_a(unified_results(spark, sf))
    cells = F.struct(*[F.col(c).cast("string").alias(c) for c in R.DISPLAY_A])
    return rows.select("row_id", F.to_csv(cells, {k: str(v).lower() if isinstance(v, bool) else v for k, v in R.CSV_OPTIONS.items()}).alias("line"))


def catalog_csv(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1: catalogue lines read with the source's options."""
    lines = X.catalog_lines(X.load(spark, sf, "pages"))
    cells = F.from_csv("value", "dataset_name string, website_link string, rest string", CSV_OPTIONS)
    return lines.select("page_id", cells["dataset_name"].alias("dataset_name"), cells["website_link"].alias("website_link"))


def _catalog_records(spark: SparkSession, sf: str) -> DataFrame:
    lines = X.catalog_file_lines(X.load(spark, sf, "pages"), X.load(spark, sf, "region"))
    return with_cells(records(lines), ["Dataset Name", "Website Link", "x"]).withColumnRenamed("number", "row_id")


def catalog_records(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1, MAP-1: the good records of catalogue files, numbered in their order."""
    return named(_catalog_records(spark, sf))


def catalog_bad_records(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1: the records that couldn't be read, and why."""
    return bad_records(_catalog_records(spark, sf))


def result_a(spark: SparkSession, sf: str) -> DataFrame:
    return R.result_a(unified_results(spark, sf))


def result_b(spark: SparkSession, sf: str) -> DataFrame:
    return R.result_b(unified_results(spark, sf))


def result_unified(spark: SparkSession, sf: str) -> DataFrame:
    u = unified_results(spark, sf)
    return u.withColumn("scraped_file_formats", F.array_join("scraped_file_formats", SEP))


def component_scores(spark: SparkSession, sf: str) -> DataFrame:
    return R.component_scores(unified_results(spark, sf))


def strategy_summary(spark: SparkSession, sf: str) -> DataFrame:
    return R.strategy_summary(unified_results(spark, sf))


def dataset_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return R.dataset_ranking(unified_results(spark, sf))


def score_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return A.score_pairs(unified_results(spark, sf))


def strategy_agreement(spark: SparkSession, sf: str) -> DataFrame:
    return A.agreement(score_pairs(spark, sf))


def strategy_rank_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return A.rank_correlation(score_pairs(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "extract_title": _page_field("title"),
    "extract_description": _page_field("description"),
    "extract_text": extract_text,
    "extract_license": _page_field("license_info"),
    "extract_formats": _page_field("file_formats", lambda c: F.array_join(c, SEP)),
    "extract_links": _page_field("download_links", lambda c: F.array_join(c, SEP)),
    "extract_snippet": _page_field("raw_text_snippet"),
    "scrape_record_a": _record("A"),
    "scrape_record_b": _record("B"),
    "catalog_join": catalog_join,
    "strategy_fanout": strategy_fanout,
    "prompt_user_a": _prompt("A"),
    "prompt_user_b": _prompt("B"),
    "request_envelope": request_envelope,
    "parse_strict": _parse("A"),
    "parse_lenient": _parse("B"),
    "validate_a": _validate("A"),
    "validate_b": _validate("B"),
    "reply_source": reply_source,
    "request_json": request_json,
    "result_csv_line": result_csv_line,
    "catalog_csv": catalog_csv,
    "catalog_records": catalog_records,
    "catalog_bad_records": catalog_bad_records,
    "result_a": result_a,
    "result_b": result_b,
    "result_unified": result_unified,
    "component_scores": component_scores,
    "strategy_summary": strategy_summary,
    "dataset_ranking": dataset_ranking,
    "score_pairs": score_pairs,
    "strategy_agreement": strategy_agreement,
    "strategy_rank_correlation": strategy_rank_correlation,
}
