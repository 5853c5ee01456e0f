"""Replies scored as they arrive (Structured Streaming).

A scoring service writes reply files while the job runs. Each reply echoes the
``request_id, strategy, row_id`` of its request line, so parsing and validation need no
join: they are a projection of the stream. What is kept per request is the rank and the
text of the best reply so far: a reply is appended to the table only if it is better
(:func:`fairgauge.operators.joins.reply_rank`), and so replaces the earlier one there. A
request's state goes when no reply came for ``timeout``; if one comes later still, it is
compared in the table (:func:`latest_scores`), which holds few rows a request.

:func:`fairgauge.plans.evaluate.streamed_results` joins that table to the requests.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fairgauge.operators.joins import reply_rank
from fairgauge.operators.parse import SCORE_COLUMNS, lenient, multi_row_reply, strict
from fairgauge.operators.validate import valid_a, valid_b
from fairgauge.plans.strategies import STRATEGIES
from fairgauge.sources.replies import reply_content

REPLY_STREAM_SCHEMA = "request_id string, strategy string, row_id bigint, response string, body string"
#: How long after its last reply a request's state is kept.
TIMEOUT_HOURS = 24 * 7
#: Columns of a parsed reply that results take over.
PARSED = ("parse_ok", "parsed_dataset_name", *SCORE_COLUMNS)


def dialect_of(strategy: F.Column) -> F.Column:
    m = F.create_map(*[x for s in STRATEGIES for x in (F.lit(s["strategy"]), F.lit(s["dialect"]))])
    return m[strategy]


def score_replies(replies: DataFrame) -> DataFrame:
    """Parse and validate replies by their strategy's dialect (batch or
    streaming input alike)."""
    response = F.coalesce(F.col("response"), reply_content("body")) if "body" in replies.columns else F.col("response")
    base = replies.select(
        "request_id", "strategy", "row_id",
        dialect_of(F.col("strategy")).alias("dialect"),
        response.alias("response"),
    )
    r, d = F.col("response"), F.col("dialect")
    both = base.select("*", F.inline(F.array(F.struct(strict(r).alias("strict"), lenient(r).alias("lenient")))))
    own = F.when(d == "A", F.col("strict")).when(d == "B", F.col("lenient"))
    rank = reply_rank(r, F.col("strict.parse_ok"), F.col("lenient.parse_ok")).alias("reply_rank")
    parsed = both.select(*base.columns, rank, *[own[c].alias(c) for c in PARSED])
    checked = valid_b(valid_a(parsed))
    return checked.select(
        "request_id", "strategy", "row_id", "dialect",
        F.col("response").alias("fair_raw_output"),
        F.coalesce("parse_ok", F.lit(False)).alias("parse_success"),
        F.col("dialect").isNull().alias("unknown_strategy"),
        "valid_scores", "parsed_dataset_name", "f_score", "a_score", "i_score", "r_score",
        "f_valid", "a_valid", "i_valid", "r_valid", "all_valid",
        multi_row_reply(F.col("response")).alias("multi_row_reply"), "reply_rank",
    )


def better_replies(scored: DataFrame, timeout_hours: int = TIMEOUT_HOURS) -> DataFrame:
    """Of a stream of scored replies those that are better than all before of their request;
    ``new_replies`` counts the replies since the request's last row. State per request: rank
    and text of the best reply, and the replies not counted in a row yet. At a time-out with
    such replies left, a row without text hands their count over.

    Time is that of the batch a reply comes in, so none is late; it goes on with the
    batches, and a run over what is there ends (with time-outs by the clock, none would)."""
    scored_columns = scored.columns
    columns = [*scored_columns, "new_replies"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in scored.schema.fields] + ["new_replies bigint"])
    nullable = {f.name: {"bigint": "Int64", "int": "Int32", "boolean": "boolean"}.get(f.dataType.simpleString(), object) for f in scored.schema.fields}

    def compare(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rank, text, pending = state.get if state.exists else (9, "", 0)
        if state.hasTimedOut:
            state.remove()
            if pending:
                rest = dict.fromkeys(columns) | {"request_id": key[0], "reply_rank": 9, "new_replies": pending}
                yield pd.DataFrame([rest], columns=columns).astype(nullable)
            return
        best = None
        for part in parts:
            pending += len(part)
            texts = part["fair_raw_output"].fillna("")
            first = part[scored_columns].assign(_text=texts).sort_values(["reply_rank", "_text"], kind="stable").head(1)
            found = (int(first["reply_rank"].iloc[0]), first["_text"].iloc[0])
            if found < (rank, text):
                (rank, text), best = found, first
        if best is not None:
            yield best.drop(columns="_text").assign(new_replies=pending)[columns].astype(nullable)
            pending = 0
        state.update((rank, text, pending))
        state.setTimeoutTimestamp(state.getCurrentProcessingTimeMs() + timeout_hours * 3_600_000)

    timed = scored.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "0 seconds")
    return timed.groupBy("request_id").applyInPandasWithState(
        compare, schema, "rank int, text string, pending bigint", "append", GroupStateTimeout.EventTimeTimeout
    )


def latest_scores(table: DataFrame, buckets: int | None = None) -> DataFrame:
    """The best reply of each request in the stream's table, parsed as it stands there, and
    the replies counted so far; dealt out like requests of so many ``buckets``."""
    dealt = table.repartition(buckets, "request_id") if buckets else table
    parsed = [F.col("parse_success").alias("parse_ok"), *[c for c in PARSED if c != "parse_ok"]]
    best = F.min(F.struct("reply_rank", F.col("fair_raw_output").alias("response"), *parsed)).alias("best")
    kept = dealt.groupBy("request_id").agg(best, F.sum("new_replies").alias("reply_count"))
    return kept.select("request_id", "best.response", *[F.col(f"best.{c}").alias(c) for c in PARSED], "reply_count")


def read_reply_stream(spark: SparkSession, replies_dir: str, fmt: str = "json") -> DataFrame:
    return spark.readStream.schema(REPLY_STREAM_SCHEMA).format(fmt).load(replies_dir)


def start_scoring(
    spark: SparkSession,
    replies_dir: str,
    out_path: str,
    checkpoint: str,
    fmt: str = "json",
    available_now: bool = True,
    timeout_hours: int = TIMEOUT_HOURS,
) -> StreamingQuery:
    """Score the reply files under ``replies_dir`` into ``out_path``.

    ``available_now`` processes what is there and stops (a scheduled run);
    otherwise the query keeps running on a 30-second trigger.
    """
    scored = better_replies(score_replies(read_reply_stream(spark, replies_dir, fmt)), timeout_hours)
    writer = (
        scored.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
