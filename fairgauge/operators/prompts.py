"""Prompt and request building, PR-1 … PR-6.

Runs after the last shuffle of the request side, as one projection per
(catalogue row, strategy). Fixed texts are literals inside ``concat``; only
the evidence fields and the dataset cells vary per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairgauge.functions.text import fstr, py_list_repr
from fairgauge.plans import strategies as S

_FIELD = re.compile(r"\{(\w+)\}")


def render(template: str, values: dict[str, Column]) -> list[Column]:
    """Split a ``{name}`` template into literal and column pieces."""
    parts = _FIELD.split(template)
    out: list[Column] = []
    for i, part in enumerate(parts):
        if i % 2:
            out.append(values[part])
        elif part:
            out.append(F.lit(part))
    return out


def _values() -> dict[str, Column]:
    return {
        "title": F.col("title"),
        "description": F.col("description"),
        "license_info": F.col("license_info"),
        "file_formats_list": py_list_repr(F.col("file_formats")),
        "file_formats_joined": F.array_join(F.col("file_formats"), ", "),
        "download_links_list": py_list_repr(F.col("download_links")),
        "raw_text_snippet": F.col("raw_text_snippet"),
        "dataset_name": fstr(F.col("dataset_name")),
        "website_link": fstr(F.col("website_link")),
    }


def _by_strategy(field: str, strategies: list[dict]) -> Column:
    expr = None
    for s in strategies:
        cond = F.col("strategy") == s["strategy"]
        expr = F.when(cond, F.lit(s[field])) if expr is None else expr.when(cond, F.lit(s[field]))
    return expr


def user_content(strategies: list[dict]) -> Column:
    """PR-1 … PR-4: the user message. Dialect A: rubric, evidence (lists as
    Python list text), instruction. Dialect B: rubric, the strategy's
    examples, evidence (formats comma-joined), shorter instruction."""
    v = _values()
    a = F.concat(F.lit(S.RUBRIC), *render(S.EVIDENCE_A, v), *render(S.INSTRUCTION_A, v))
    b = F.concat(
        F.lit(S.RUBRIC), _by_strategy("examples", strategies),
        *render(S.EVIDENCE_B, v), *render(S.INSTRUCTION_B, v),
    )
    return F.when(F.col("dialect") == "A", a).otherwise(b)


def request_id() -> Column:
    """PR-6: content address of a request — strategy, row, the strategy's
    parameters and both messages."""
    parts = [
        F.col("strategy"), F.col("row_id").cast("string"), F.lit(S.MODEL), F.lit(str(S.TEMPERATURE)),
        F.col("max_tokens").cast("string"), F.col("system_content"), F.col("user_content"),
    ]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def with_requests(df: DataFrame, strategies: list[dict]) -> DataFrame:
    """PR-5/PR-6: add ``user_content``, ``request_id`` and the envelope
    fields. ``df`` is the fan-out (one row per catalogue row and strategy)
    with the dialect's error record already filled."""
    return (
        df.withColumn("user_content", user_content(strategies))
        .withColumn("system_content", _by_strategy("system", strategies))
        .withColumn("max_tokens", _by_strategy("max_tokens", strategies).cast("int"))
        .withColumn("request_id", request_id())
    )


def envelope(df: DataFrame) -> DataFrame:
    """PR-5: the chat request as a struct, one per row, keyed by request id."""
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.col("system_content").alias("content")),
        F.struct(F.lit("user").alias("role"), F.col("user_content").alias("content")),
    )
    body = F.struct(
        F.lit(S.MODEL).alias("model"),
        messages.alias("messages"),
        F.lit(S.TEMPERATURE).alias("temperature"),
        F.col("max_tokens").alias("max_tokens"),
    )
    return df.select("request_id", "strategy", "row_id", body.alias("request"))


def request_lines(df: DataFrame) -> DataFrame:
    """SNK-2: one JSON line per request, ready for ``write.text``."""
    return envelope(df).select(
        F.to_json(F.struct("request_id", "strategy", "row_id", "request")).alias("value")
    )
