"""Requests over several runs: which are new, and their keys bucketed for JOIN-2.

A run is a batch of the catalogue. Its requests go to a directory of their own,
``requests/run=<run>``, which is never written twice. A request that an earlier run has
asked is left out: the ids of all earlier runs make a Bloom filter of one 64-bit word per
few ids; a request whose bits aren't all set there is new for sure and stays where it is,
and only the others are joined with the ids. The filter has at most ``MOST_WORDS`` rows, so
it may be broadcast; past that it lets more through, to the join.

The columns that results need, without prompts, are kept in a table bucketed and sorted by
``request_id``, so that replies can be joined again and again without moving requests.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids per word of the filter, bits set by an id, and the most words (16 MB of them).
IDS_PER_WORD, BITS, MOST_WORDS = 4, 5, 1 << 20
BUCKETS = 256

#: What results read of a request.
KEY_COLUMNS = (
    "request_id", "strategy", "dialect", "row_id", "dataset_name", "website_link",
    "title", "license_info", "file_formats", "scrape_error", "run",
)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None if there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _mask(request_id: Column) -> Column:
    """The bits of an id in its word, six bits of its hash for each."""
    h = F.xxhash64(request_id, F.lit(1))
    out = F.lit(0).cast("bigint")
    for k in range(BITS):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return out


def bloom(ids: DataFrame, words: int) -> DataFrame:
    """``word, bits``: the filter over ``request_id``."""
    word = F.pmod(F.xxhash64("request_id"), F.lit(words)).alias("word")
    return ids.select(word, _mask(F.col("request_id")).alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))


def not_asked(requests: DataFrame, asked: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """The rows of ``requests`` whose ``request_id`` isn't among those of ``asked``."""
    ids = asked.select("request_id")
    words = min(most_words, max(1, ids.count() // IDS_PER_WORD))
    word = F.pmod(F.xxhash64("request_id"), F.lit(words))
    probed = requests.withColumn("word", word).join(F.broadcast(bloom(ids, words)), "word", "left")
    mask = _mask(F.col("request_id"))
    maybe = F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False))
    sure = probed.where(~maybe).select(*requests.columns)
    rest = probed.where(maybe).select(*requests.columns).join(ids, "request_id", "left_anti")
    return sure.unionByName(rest)


def _table(path: str) -> str:
    return f"fairgauge_keys_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def open_keys(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The bucketed key table at ``path`` and its number of buckets, which stands beside it."""
    spec = spark.read.schema("buckets int, columns string").json(f"{path}_spec").first()
    name = _table(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({spec['columns']}) USING parquet "
        f"CLUSTERED BY (request_id) SORTED BY (request_id) INTO {spec['buckets']} BUCKETS LOCATION '{path}'"
    )
    spark.catalog.refreshTable(name)
    return spark.table(name), spec["buckets"]


def add_keys(requests: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Append the key columns of ``requests`` to the table at ``path``, which is made with
    ``buckets`` if it isn't there."""
    spark = requests.sparkSession
    keys = requests.select(*KEY_COLUMNS)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields)
    try:
        _, buckets = open_keys(spark, path)
    except AnalysisException:
        spark.createDataFrame([(buckets, columns)], "buckets int, columns string").coalesce(1).write.json(f"{path}_spec")
        open_keys(spark, path)
    keys.repartition(buckets, "request_id").write.insertInto(_table(path))
