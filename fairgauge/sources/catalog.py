"""SRC-1/SRC-2: the dataset catalogue, and the URL key it joins on.

The catalogue is a CSV of ``Dataset Name, Website Link`` (other columns are
ignored). All columns are read as strings — no type inference, so a name
like ``NA`` or ``1`` stays text — and each row gets a surrogate ``row_id``
because names repeat: a caller's key column, or else the record's number in the
catalogue. Neither depends on how the file was split, so the requests of a rerun
keep their ids, and results can be put in the catalogue's order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairgauge.functions.text import strip
from fairgauge.sources.records import read_lines, records, with_cells

#: How catalogue cells are quoted: a quote inside a quoted cell is doubled.
CSV_OPTIONS = {"escape": '"'}

#: Header names the scoring scripts read, and our column names for them.
REQUIRED_COLUMNS = {"Dataset Name": "dataset_name", "Website Link": "website_link"}


def url_key(url: Column) -> Column:
    """Join key for a link: surrounding whitespace and the fragment removed.

    The fragment is never sent over HTTP, so ``page#a`` and ``page#b`` fetch
    the same page. Nothing else is normalised: no decoding, no reordering.
    """
    return F.regexp_replace(strip(url), "(?s)#.*", "")


def check_columns(columns: list[str]) -> None:
    """SRC-2: refuse a catalogue without both required headers."""
    if not all(c in columns for c in REQUIRED_COLUMNS):
        missing = [c for c in REQUIRED_COLUMNS if c not in columns]
        raise ValueError(f"the catalogue lacks {missing}; it has {columns}")


def catalog_records(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: every data record of the catalogue: its columns, ``row_id`` (its number from 0
    in the order of the files' names and of their records, whatever the splits) and, for a
    bad record, ``problem`` and the ``record`` itself.

    A CSV (UTF-8, BOM and CRLF tolerated) is read by many tasks, cells over several lines
    included (:mod:`fairgauge.sources.records`). A parquet catalogue has the same columns
    and no bad records."""
    if path.endswith(".parquet"):
        raw = spark.read.parquet(path)
        check_columns(raw.columns)
        rows = raw.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
        sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
        firsts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))  # a row per file
        numbered = rows.join(firsts, "_file").withColumn("row_id", F.col("_first") + F.col("_index"))
        none = F.lit(None).cast("string")
        return numbered.drop("_file", "_index", "_n", "_first").withColumns({"problem": none, "record": none})
    first = spark.read.option("header", True).option("inferSchema", False).options(**CSV_OPTIONS).csv(path)
    header = [c.lstrip("\ufeff") for c in first.columns]
    check_columns(header)
    return with_cells(records(read_lines(spark, path)), header).withColumnRenamed("number", "row_id")


def named(rows: DataFrame, key_column: str | None = None) -> DataFrame:
    """The good records under our column names. ``key_column`` names an integer column that
    serves as ``row_id``."""
    cols = [F.col(f"`{src}`").cast("string").alias(dst) for src, dst in REQUIRED_COLUMNS.items()]
    row_id = F.col(f"`{key_column}`").cast("bigint").alias("row_id") if key_column else F.col("row_id")
    return rows.where(F.col("problem").isNull()).select(*cols, row_id)


def bad_records(rows: DataFrame) -> DataFrame:
    """``row_id, problem, record`` of the records that couldn't be read."""
    return rows.where(F.col("problem").isNotNull()).select("row_id", "problem", "record")


def read_catalog(spark: SparkSession, path: str, key_column: str | None = None) -> DataFrame:
    """``dataset_name, website_link, row_id`` of the catalogue's good records."""
    return named(catalog_records(spark, path), key_column)


def keyed(catalog: DataFrame) -> DataFrame:
    return catalog.withColumn("url_key", url_key(F.col("website_link")))
