"""SRC-4, re-aimed: model replies arrive as a table keyed by ``request_id``.

Two shapes are accepted: flat ``(request_id, response)``, or the raw chat
completion ``(request_id, body)`` where ``body`` is the service's JSON and
the reply is ``choices[0].message.content``. A body without choices gives a
NULL response, which parses as no match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPLETION_SCHEMA = "choices array<struct<message:struct<content:string>>>"


def reply_content(body: str = "body"):
    """``choices[0].message.content`` of a chat-completion JSON string."""
    parsed = F.from_json(F.col(body), COMPLETION_SCHEMA)
    return F.get(parsed["choices"], 0)["message"]["content"]


def normalise_replies(df: DataFrame) -> DataFrame:
    """``(request_id, response)`` from either shape; a row may carry both."""
    parts = []
    if "response" in df.columns:
        parts.append(F.col("response").cast("string"))
    if "body" in df.columns:
        parts.append(reply_content("body"))
    if not parts:
        raise ValueError("replies need 'request_id' and either 'response' or 'body'")
    return df.select("request_id", F.coalesce(*parts).alias("response"))


def read_replies(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Read a replies table (parquet by default; ``json`` for JSON lines)."""
    fmt = fmt or ("json" if path.endswith((".json", ".jsonl")) else "parquet")
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.schema("request_id string, response string, body string")
    return normalise_replies(reader.load(path))
