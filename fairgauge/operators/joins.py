"""JOIN-1 (catalogue ⟕ pages), MAP-2 (strategy fan-out), JOIN-2 (requests ⟕
replies).

JOIN-1 asks first which pages the catalogue needs, on narrow columns alone:
link keys that occur in the catalogue, and of each key the lowest ``page_id``.
Only those pages' HTML is read and extracted, so the cost follows the
catalogue, not the crawl, and copies of a page are never extracted.

It is then a many-to-one lookup: many datasets may share one landing page, and
one page may hold a third of the catalogue. A key with more rows than an even
share of a shuffle partition is salted into as many buckets as it has shares;
its page is replicated once per bucket, at most once per partition. Rows
without a link never enter the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairgauge.operators.extract import SCRAPED_FIELDS, with_scraped
from fairgauge.operators.parse import SCORE_COLUMNS, lenient, strict
from fairgauge.sources.catalog import url_key

_PAGE_COLUMNS = ("page_id",) + SCRAPED_FIELDS + ("scrape_error",)


def _shuffle_partitions(df: DataFrame) -> int:
    """The session's shuffle partition count, or the cluster's slots when
    the setting is not a number."""
    value = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    try:
        return int(value)
    except ValueError:
        return df.sparkSession.sparkContext.defaultParallelism


def needed_pages(catalog: DataFrame, pages: DataFrame) -> DataFrame:
    """``url_key, page_id`` of the one page each catalogued link needs: the
    lowest ``page_id`` of its key. Reads ``page_id`` and ``url`` only."""
    keys = catalog.select("url_key").where(F.col("url_key").isNotNull()).distinct()
    narrow = pages.select("page_id", url_key(F.col("url")).alias("url_key"))
    return narrow.join(keys, "url_key", "left_semi").groupBy("url_key").agg(F.min("page_id").alias("page_id"))


def catalogued_pages(catalog: DataFrame, pages: DataFrame, page_tasks: int | None = None) -> DataFrame:
    """The extracted record of each page that the catalogue needs, one per
    key. Rows that share a ``page_id`` are told apart by a hash of their HTML.
    ``page_tasks`` deals the needed pages to so many tasks, for a caller whose
    crawl comes in fewer row groups than the cluster has cores."""
    need = needed_pages(catalog, pages).select(F.col("url_key").alias("_key"), F.col("page_id").alias("_id"))
    keyed = pages.select("page_id", url_key(F.col("url")).alias("url_key"), "html")
    same = (keyed["url_key"] == need["_key"]) & keyed["page_id"].eqNullSafe(need["_id"])
    needed = keyed.join(need, same, "left_semi")
    hashed = (needed.repartition(page_tasks) if page_tasks else needed).withColumn("_tie", F.xxhash64("html"))
    record = F.struct(*[F.col(c) for c in _PAGE_COLUMNS])
    return with_scraped(hashed, "html").groupBy("url_key").agg(F.min_by(record, "_tie").alias("_page"))


def hot_keys(catalog: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Keys that hold more than ``hot_rows`` catalogue rows, with their bucket
    count. By default that is an even share of a shuffle partition, so there are
    fewer hot keys, and fewer buckets of a key, than partitions."""
    parts = _shuffle_partitions(catalog)
    linked = catalog.where(F.col("url_key").isNotNull())
    counts = linked.groupBy("url_key").agg(F.count(F.lit(1)).alias("_n"))
    share = F.lit(hot_rows) if hot_rows else F.greatest(F.lit(1), linked.select(F.count(F.lit(1))).scalar() / parts)
    return counts.where(F.col("_n") > share).select(
        "url_key", F.least(F.ceil(F.col("_n") / share), F.lit(parts)).cast("int").alias("_buckets")
    )


def attach_pages(
    catalog: DataFrame, pages: DataFrame, hot_rows: int | None = None, page_tasks: int | None = None
) -> DataFrame:
    """JOIN-1: every catalogue row with the extracted record of its page.

    ``catalog`` needs ``row_id`` and ``url_key``; ``pages`` is the crawl table.
    A row whose key finds no page (or has no key) keeps NULL fields and the
    ``no_page`` error.
    """
    hot = hot_keys(catalog, hot_rows)
    buckets = F.coalesce(F.col("_buckets"), F.lit(1))
    left = (
        catalog.where(F.col("url_key").isNotNull())
        .join(hot, "url_key", "left")
        .withColumn("_salt", F.pmod(F.xxhash64("row_id"), buckets).cast("int"))
        .drop("_buckets")
    )
    right = (
        catalogued_pages(catalog, pages, page_tasks)
        .join(hot, "url_key", "left")
        .select("url_key", F.explode(F.sequence(F.lit(0), buckets - 1)).alias("_salt"), "_page")
    )
    joined = left.join(right, ["url_key", "_salt"], "left").drop("_salt")
    unlinked = catalog.where(F.col("url_key").isNull()).withColumn("_page", F.lit(None).cast(right.schema["_page"].dataType))
    rows = joined.select(*catalog.columns, "_page").unionByName(unlinked.select(*catalog.columns, "_page"))
    error = F.when(F.col("_page").isNull(), F.lit("no_page")).otherwise(F.col("_page.scrape_error"))
    fields = [F.col(f"_page.{c}").alias(c) for c in _PAGE_COLUMNS if c != "scrape_error"]
    return rows.select(*catalog.columns, *fields, error.alias("scrape_error"), error.isNull().alias("scrape_ok"))


def fan_out(df: DataFrame, strategies: list[dict]) -> DataFrame:
    """MAP-2: one row per (catalogue row, strategy). The strategy list is a
    handful of literals, so this is a Generate on each row — no join."""
    rows = F.array(
        *[
            F.struct(
                F.lit(s["strategy"]).alias("strategy"),
                F.lit(s["dialect"]).alias("dialect"),
                F.lit(i).alias("strategy_ord"),
            )
            for i, s in enumerate(strategies)
        ]
    )
    return df.select("*", F.inline(rows))


def reply_rank(response: Column, strict_ok: Column, lenient_ok: Column) -> Column:
    """The order in which replies to one request are preferred: one that the strict parser
    reads (then the lenient one does, too), one that only the lenient one reads, other text,
    an empty one, none. So in either dialect a reply with scores goes before one without."""
    return (
        F.when(strict_ok, 0).when(lenient_ok, 1).when(F.btrim(response) != "", 2).when(response.isNotNull(), 3).otherwise(4)
    )


def dedupe_replies(replies: DataFrame) -> DataFrame:
    """One reply per request by :func:`reply_rank`, equals by the smallest text, so that a
    recomputed task picks the same one; its parse in both dialects (``strict``,
    ``lenient``); and ``reply_count``. Replies are parsed once, before the shuffle, and
    merged on its map side."""
    r = F.col("response")
    parsed = replies.select("request_id", "response", F.inline(F.array(F.struct(strict(r).alias("strict"), lenient(r).alias("lenient")))))
    rank = reply_rank(r, F.col("strict.parse_ok"), F.col("lenient.parse_ok"))
    best = F.min(F.struct(rank.alias("rank"), "response", "strict", "lenient")).alias("best")
    kept = parsed.groupBy("request_id").agg(best, F.count(F.lit(1)).alias("reply_count"))
    return kept.select("request_id", "best.response", "best.strict", "best.lenient", "reply_count")


def attach_replies(requests: DataFrame, replies: DataFrame, buckets: int | None = None) -> DataFrame:
    """JOIN-2: requests ⟕ replies on the content-addressed ``request_id``, with the reply's
    parse in the request's dialect. A request without a reply keeps a NULL response.

    ``buckets``: the requests are bucketed so by ``request_id``; the replies are dealt out
    in the same way, and the requests stay where they are."""
    dealt = replies.repartition(buckets, "request_id") if buckets else replies
    joined = requests.join(dedupe_replies(dealt), "request_id", "left")
    parsed = F.when(F.col("dialect") == "A", F.col("strict")).when(F.col("dialect") == "B", F.col("lenient"))
    fields = [parsed[c].alias(c) for c in ("parse_ok", "parsed_dataset_name", *SCORE_COLUMNS)]
    count = F.coalesce("reply_count", F.lit(0).cast("bigint")).alias("reply_count")
    return joined.select(*requests.columns, "response", *fields, count)
