"""SRC-3, re-aimed: the crawl table ``pages(page_id, url, html)`` replaces the
per-row HTTP fetch.

Extraction is a projection on the scan: the wide ``html`` column is read,
reduced to a record of a few KB and dropped inside one stage. How many tasks
share that stage follows from the crawl's row groups and
``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairgauge.operators.extract import with_scraped
from fairgauge.sources.catalog import url_key


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")


def extract_pages(pages: DataFrame) -> DataFrame:
    """Keyed, extracted pages: ``page_id, url_key`` plus the scraped record, for
    every row of the crawl (JOIN-1 extracts only what a catalogue needs)."""
    return with_scraped(pages.select("page_id", url_key(F.col("url")).alias("url_key"), "html"), "html")
