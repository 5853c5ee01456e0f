"""Catalogue source (SRC-1/2) and the page join (JOIN-1) with hot-key salting."""

import io
import os
import random
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fairgauge.operators.joins import attach_pages, hot_keys, needed_pages
from fairgauge.plans import fixtures as X
from fairgauge.sources.catalog import bad_records, catalog_records, keyed, named, read_catalog
from fairgauge.sources.pages import extract_pages
from fairgauge.sources.records import OPEN_QUOTE, TOO_MANY, read_lines
from tests.conftest import SF_SMALL

CSV = (
    "﻿Dataset Name,Website Link,data file\r\n"
    "Alpha,https://a.example.org/x ,f1\r\n"
    "Beta,https://a.example.org/x#frag,\r\n"
    "Alpha,https://b.example.org/y?q=%20,f3\r\n"
    "NA,,f4\r\n"
    "1,\"https://c.example.org/z,comma\",f5\r\n"
)


def _write(text):
    d = tempfile.mkdtemp(prefix="fairgauge-test-")
    p = os.path.join(d, "catalog.csv")
    with open(p, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return p


def test_read_catalog_traps(spark):
    rows = keyed(read_catalog(spark, _write(CSV))).collect()
    assert {(r["dataset_name"], r["website_link"], r["url_key"]) for r in rows} == {
        ("Alpha", "https://a.example.org/x ", "https://a.example.org/x"),  # the link is kept verbatim
        ("Beta", "https://a.example.org/x#frag", "https://a.example.org/x"),
        ("Alpha", "https://b.example.org/y?q=%20", "https://b.example.org/y?q=%20"),
        ("NA", None, None),
        ("1", "https://c.example.org/z,comma", "https://c.example.org/z,comma"),
    }
    assert len({r["row_id"] for r in rows}) == len(rows) == 5


def test_row_ids_do_not_depend_on_splits(spark):
    path = _write("Dataset Name,Website Link\r\n" + "".join(f"D{i % 700},http://x/{i % 350}\r\n" for i in range(4000)))
    read = lambda: sorted(tuple(r) for r in read_catalog(spark, path).select("row_id", "dataset_name", "website_link").collect())
    whole = read()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert read() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({r[0] for r in whole}) == 4000


def test_multi_line_cells_and_key_column(spark):
    path = _write('Dataset Name,Website Link,n\r\n"two\nlines",http://x,7\r\nB,http://y,8\r\n')
    rows = read_catalog(spark, path, key_column="n").collect()
    assert {(r["row_id"], r["dataset_name"]) for r in rows} == {(7, "two\nlines"), (8, "B")}


@pytest.fixture
def split_size(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _random_csv(rnd):
    """A catalogue that pandas reads: quoted cells over lines, stray quotes, blank lines."""
    def cell():
        body = "".join(rnd.choice(["a", "b", " ", "é", "x" * rnd.randrange(30)]) for _ in range(rnd.randrange(4)))
        kind = rnd.randrange(5)
        if kind == 0:
            inside = body + rnd.choice(['""', ",", "\n", "\r\n", "\n\n", '"",""\n']) + body
            return f'"{inside}"' + rnd.choice(["", "", "tail"])
        return 'a"' + body if kind == 1 else body + rnd.choice(["", 'q"'])
    end = lambda: rnd.choice(["\n", "\r\n"])
    rows = ["Dataset Name,Website Link,x"]
    for _ in range(rnd.randrange(1, 60)):
        rows.append(",".join(cell() for _ in range(rnd.randrange(1, 4))))
        if rnd.random() < 0.2:
            rows.append("")
    return "".join(r + end() for r in rows)


@pytest.mark.parametrize("seed", range(4))
def test_records_equal_pandas_under_any_split(spark, split_size, seed):
    text = _random_csv(random.Random(seed))
    path = _write(text)
    want = pd.read_csv(io.StringIO(text, newline=""), dtype=str, keep_default_na=False)
    want = [tuple(c or None for c in r) for r in want[["Dataset Name", "Website Link"]].itertuples(index=False, name=None)]
    for size in (1 << 27, 37):
        split_size(size)
        assert read_lines(spark, path).rdd.getNumPartitions() > (1 if size < 100 else 0)
        rows = read_catalog(spark, path).collect()
        assert [(r["dataset_name"], r["website_link"]) for r in sorted(rows, key=lambda r: r["row_id"])] == want
        assert sorted(r["row_id"] for r in rows) == list(range(len(want)))


def test_bad_records_are_set_apart(spark, split_size):
    d = os.path.dirname(_write('Dataset Name,Website Link\nA,http://a\nB,http://b,one too many\nC,http://c\n'))
    with open(f"{d}/later.csv", "w") as f:
        f.write('Dataset Name,Website Link\nD,http://d\n"never closed,http://e\nF,http://f\nG')
    for size in (1 << 27, 11):
        split_size(size)
        rows = catalog_records(spark, d)
        assert sorted((r["row_id"], r["dataset_name"]) for r in named(rows).collect()) == [(0, "A"), (2, "C"), (3, "D")]
        assert sorted(tuple(r) for r in bad_records(rows).collect()) == [
            (1, TOO_MANY, "B,http://b,one too many"), (4, OPEN_QUOTE, '"never closed,http://e')]


def test_a_row_of_many_copies_stays_spread(spark, split_size):
    path = _write("Dataset Name,Website Link\n" + "".join(("same,http://x\n" if i % 4 else f"D{i},http://x\n") for i in range(40_000)))
    split_size(80_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = read_catalog(spark, path).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in per_task) == 40_000 and max(r["count"] for r in per_task) < 20_000


def test_parquet_rows_are_numbered_in_order(spark, split_size):
    d = tempfile.mkdtemp(prefix="fairgauge-test-")
    spark.range(0, 3000, 1, 3).selectExpr("concat('D', id) AS `Dataset Name`", "'http://x' AS `Website Link`").write.parquet(f"{d}/cat.parquet")
    for size in (1 << 27, 5000):
        split_size(size)
        rows = read_catalog(spark, f"{d}/cat.parquet").collect()
        assert sorted((r["row_id"], r["dataset_name"]) for r in rows) == [(i, f"D{i}") for i in range(3000)]


def test_missing_column_is_rejected(spark):
    with pytest.raises(ValueError):
        read_catalog(spark, _write("Name,Website Link\r\nA,http://x\r\n"))


@pytest.fixture(scope="module")
def inputs(spark):
    pages = X.load(spark, SF_SMALL, "pages")
    cat = keyed(X.catalog_fixture(pages, X.load(spark, SF_SMALL, "nation"), X.load(spark, SF_SMALL, "region")))
    return cat, X.overlay_pages(pages)


def _rows(df):
    return sorted(tuple(r) for r in df.select("row_id", "page_id", "scrape_error", "title").collect())


def test_salted_join_equals_plain_join(spark, inputs):
    cat, pages = inputs
    salted = attach_pages(cat, pages, hot_rows=4)
    plain = attach_pages(cat, pages, hot_rows=10**12)
    assert hot_keys(cat, 4).count() >= 1
    assert _rows(attach_pages(cat, pages)) == _rows(plain)
    assert _rows(salted) == _rows(plain)
    assert salted.count() == cat.count()


def test_join_picks_lowest_page_per_key(spark, inputs):
    cat, crawl = inputs
    got = {r["row_id"]: r["page_id"] for r in attach_pages(cat, crawl, 4).collect()}
    pages = {}
    for r in extract_pages(crawl).select("page_id", "url_key").collect():
        if r["url_key"] is not None:
            pages[r["url_key"]] = min(pages.get(r["url_key"], r["page_id"]), r["page_id"])
    for r in cat.collect():
        assert got[r["row_id"]] == pages.get(r["url_key"])


def test_buckets_are_bounded_by_the_partitions(spark, inputs):
    cat, _ = inputs
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for hot_rows in (None, 1):
        hot = hot_keys(cat, hot_rows).collect()
        assert hot and all(2 <= r["_buckets"] <= n for r in hot)
    assert len(hot_keys(cat).collect()) < n


def test_only_needed_pages_are_extracted(spark):
    crawl = [(i, "http://one/a", f"<title>copy {i}</title>") for i in range(1000, 0, -1)]
    crawl += [(5000 + i, f"http://other/{i}", "<title>no</title>") for i in range(300)]
    crawl += [(2000, "http://two/b#x", "<title>two</title>"), (2000, "http://two/b", "<title>again</title>"), (None, "http://three/c", "<title>3</title>")]
    pages = spark.createDataFrame(crawl, "page_id long, url string, html string")
    cat = keyed(spark.createDataFrame(
        [(1, "A", "http://one/a"), (2, "B", "http://two/b"), (3, "C", "http://three/c"), (4, "D", None), (5, "E", "http://gone/")],
        "row_id long, dataset_name string, website_link string"))
    assert {(r["url_key"], r["page_id"]) for r in needed_pages(cat, pages).collect()} == {
        ("http://one/a", 1), ("http://two/b", 2000), ("http://three/c", None)}
    got = {r["row_id"]: (r["title"], r["scrape_error"]) for r in attach_pages(cat, pages).collect()}
    assert got[1] == ("copy 1", None) and got[2][0] in ("two", "again") and got[3] == ("3", None)
    assert got[4] == got[5] == (None, "no_page")
    assert got == {r["row_id"]: (r["title"], r["scrape_error"]) for r in attach_pages(cat, pages.repartition(5)).collect()}


def test_rows_without_a_link_stay_where_they_are(spark):
    cat = keyed(spark.range(0, 4000, 1, 8).selectExpr(
        "id AS row_id", "'D' AS dataset_name", "if(id % 10 < 3, null, concat('http://p/', id % 50)) AS website_link"))
    pages = spark.range(50).selectExpr("id AS page_id", "concat('http://p/', id) AS url", "'<title>t</title>' AS html")
    sizes = attach_pages(cat, pages).groupBy(F.spark_partition_id().alias("p"), F.col("url_key").isNull().alias("none")).count().where("none").collect()
    assert sum(r["count"] for r in sizes) == 1200 and max(r["count"] for r in sizes) <= 200


def test_hot_key_holds_many_rows(spark, inputs):
    cat, _ = inputs
    top = cat.groupBy("url_key").count().orderBy(F.desc("count")).first()
    assert top["count"] * 3 >= cat.count()  # the fixture's hot page holds over a third


def test_read_parquet_catalogue(spark):
    d = tempfile.mkdtemp(prefix="fairgauge-test-")
    src = spark.createDataFrame([("A", "http://x/#a", 1), ("B", None, 2)], "`Dataset Name` string, `Website Link` string, n int")
    src.write.parquet(f"{d}/cat.parquet")
    rows = read_catalog(spark, f"{d}/cat.parquet").collect()
    assert {(r["dataset_name"], r["website_link"]) for r in rows} == {("A", "http://x/#a"), ("B", None)}
