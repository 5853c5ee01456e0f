"""Inputs for the registered queries, derived by Spark from the driver's
tables so that their work grows with them (DuckDB counterparts in
:mod:`fairgauge.plans.oracle`).

* ``overlay_pages`` — every page, with metadata spliced in so that each
  extraction branch has rows (the driver's pages carry no description, no
  data links and few licence words). ``page_id`` residues choose *what* is
  spliced in; no page is dropped.
* ``catalog_fixture`` — a catalogue over the pages: one row per page (with
  trailing-space and fragment variants of its link), one "mirror" row per
  page that points at the lowest page's landing page (a hot key holding
  about half the catalogue), nations with links that have no page, and
  regions with no link. Row ids are ``4 * key + kind``, so no two meet.
* ``reply_stub`` — a stand-in for the model: replies in eight shapes,
  chosen from the request's row and strategy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairgauge.plans.strategies import STRATEGY_NAMES

TITLE_TAG_RE = "<title>[^<]*</title>"
#: A value that looks like another attribute, before the real description.
LOOKALIKE_META = "<meta property=x content=\" name='description' \"><meta content='real &copy 2020' name=description>"
#: Stray quotes, look-alike values, raw controls, references without ';'.
AWKWARD_TAGS = (
    '<a href="/q.csv"">click</a><a title="see href=\'/x.csv\' here" href="/y.html">y</a>'
    '<a data-href=/n.csv HREF=/u\u200bv\u00a0w\x01.json>u</a><p class=it\'s>Body &ampx &copy 2020 &#00000000000000000065;\x01.</p>'
)


def _s(c: Column) -> Column:
    return c.cast("string")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def overlay_pages(pages: DataFrame) -> DataFrame:
    pid, html = F.col("page_id"), F.col("html")
    titled = (
        F.when(pid % 7 == 0, F.regexp_replace(html, TITLE_TAG_RE, ""))
        .when(pid % 11 == 0, F.regexp_replace(html, TITLE_TAG_RE, "<title></title>"))
        .when(pid % 13 == 12, F.replace(html, F.lit("<title>"), F.lit("<title><b>bold</b> ")))
        .otherwise(html)
    )
    meta = (
        F.when(pid % 33 == 3, F.lit('<meta name="description">'))
        .when(pid % 3 == 0, F.concat(F.lit('<meta name="description" content="  About &amp; around '), _s(pid), F.lit(' ">')))
        .when(pid % 3 == 1, F.lit('<meta name="Description" content="wrong case">'))
        .otherwise(F.lit(LOOKALIKE_META))
    )
    links = F.when(
        pid % 2 == 0,
        F.concat(
            F.lit('<a href="/data/F'), _s(pid),
            F.lit('.CSV?x=1&amp;y=2">d</a><a class="k" href="/z.zip">z</a><a href="/z.zip">z</a><a href="/r.pdf">r</a>'),
        ),
    ).otherwise(F.when(pid % 6 == 1, F.lit(AWKWARD_TAGS)).otherwise(F.lit("")))
    lic = (
        F.when(pid % 5 == 0, F.lit("<p>Released as <i>CC-BY</i> or public domain</p>"))
        .when(pid % 5 == 1, F.lit('<!-- license --><script>var k="creativecommons";</script>'))
        .otherwise(F.lit(""))
    )
    out = F.replace(titled, F.lit("</head>"), F.concat(meta, F.lit("</head>")))
    out = F.replace(out, F.lit("</nav>"), F.concat(links, F.lit("</nav>")))
    out = F.replace(out, F.lit("</article>"), F.concat(lic, F.lit("</article>")))
    return pages.select("page_id", "url", out.alias("html"))


def catalog_fixture(pages: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    pid, url = F.col("page_id"), F.col("url")
    hot_url = pages.select(F.min_by("url", "page_id")).scalar()
    link = (
        F.when(pid % 4 == 1, F.concat(url, F.lit(" ")))
        .when(pid % 4 == 2, F.concat(F.regexp_replace(url, "#.*$", ""), F.lit("#sec")))
        .otherwise(url)
    )
    base = pages.select((pid * 4).alias("row_id"), F.concat(F.lit("DS"), _s(pid)).alias("dataset_name"), link.alias("website_link"))
    mirror = pages.select(
        (pid * 4 + 1).alias("row_id"), F.concat(F.lit("MIRROR"), _s(pid)).alias("dataset_name"),
        hot_url.alias("website_link"),
    )
    nat = nation.select(
        (F.col("n_nationkey").cast("bigint") * 4 + 2).alias("row_id"), F.col("n_name").alias("dataset_name"),
        F.concat(F.lit("http://missing.example.test/"), _s(F.col("n_nationkey"))).alias("website_link"),
    )
    reg = region.select(
        (F.col("r_regionkey").cast("bigint") * 4 + 3).alias("row_id"), F.col("r_name").alias("dataset_name"),
        F.lit(None).cast("string").alias("website_link"),
    )
    return base.unionByName(mirror).unionByName(nat).unionByName(reg)


def stub_response(k: Column) -> Column:
    """Eight reply shapes keyed by ``k % 8``: a clean row, no closing pipe,
    bare numbers under the header, header then scored row, two scored rows,
    a row split over lines, an empty reply, no reply."""
    d = lambda c: _s(c)
    hdr = "| Dataset Name | F-Score (X/17) | A-Score (X/10) | I-Score (X/8) | R-Score (X/7) |\n|---|---|---|---|---|\n"
    c = k % 8
    return (
        F.when(c == 0, F.concat(F.lit("| DS"), d(k), F.lit(" | F-Score ("), d(k % 20), F.lit("/17) | A-Score ("), d(k % 13),
                                F.lit("/10) | I-Score ("), d(k % 9), F.lit("/8) | R-Score ("), d(k % 9), F.lit("/7) |")))
        .when(c == 1, F.concat(F.lit("| DS"), d(k), F.lit(" | F-Score ("), d(k % 18), F.lit("/17) | A-Score ("), d(k % 11),
                               F.lit("/10) | I-Score ("), d(k % 9), F.lit("/8) | R-Score ("), d(k % 8), F.lit("/7)")))
        .when(c == 2, F.concat(F.lit(hdr + "| DS"), d(k), F.lit(" | "), d(k % 18), F.lit(" | 8 | 7 | 4 |")))
        .when(c == 3, F.concat(F.lit(hdr + "| DS"), d(k), F.lit(" | F-Score ("), d(k % 18),
                               F.lit("/17) | A-Score (8/10) | I-Score (7/8) | R-Score (4/7) |")))
        .when(c == 4, F.concat(F.lit("| EX | F-Score (9/17) | A-Score (8/10) | I-Score (7/8) | R-Score (4/7) |\n| DS"), d(k),
                               F.lit(" | F-Score ("), d(k % 18), F.lit("/17) | A-Score ("), d(k % 11), F.lit("/10) | I-Score ("),
                               d(k % 9), F.lit("/8) | R-Score ("), d(k % 8), F.lit("/7) |")))
        .when(c == 5, F.concat(F.lit("Sure.\n|  DS"), d(k), F.lit("  |  F-Score ("), d(k % 18),
                               F.lit("/17)|A-Score (3/10) |\n I-Score (2/8) | R-Score (1/7) |")))
        .when(c == 6, F.lit(""))
        .otherwise(F.lit(None).cast("string"))
    )


def turn_replies(conversations: DataFrame) -> DataFrame:
    """Replies keyed by conversation turn (for the parser and validator queries):
    the turn's whole text around, before, after or without a score row."""
    k = F.col("conv_id") * 3 + F.col("turn")
    text, stub = F.coalesce("text", F.lit("")), F.coalesce(stub_response(k), F.lit(""))
    rows = F.concat(F.lit("| EX | F-Score (1/17) |"), text, F.lit(" | I-Score (2/8) | A-Score (3/10) |"))
    response = (
        F.when(k % 5 == 0, F.concat(text, F.lit("\n"), stub, F.lit("\n"), text))
        .when(k % 5 == 1, F.concat(rows, F.lit("\n"), stub))
        .when(k % 5 == 2, F.concat(stub, F.lit("\n"), rows))
        .when(k % 5 == 3, stub_response(k))
        .otherwise(F.col("text"))
    )
    return conversations.select("conv_id", "turn", response.alias("response"))


BARE_REPLY = "| Dataset Name | F-Score (X/17) | A-Score (X/10) | I-Score (X/8) | R-Score (X/7) |\n|---|---|---|---|---|\n| A | 9 | 8 | 7 | 4 |"


def strategy_ord() -> Column:
    return F.array_position(F.array(*[F.lit(n) for n in STRATEGY_NAMES]), F.col("strategy")) - 1


def reply_stub(requests: DataFrame) -> DataFrame:
    """Replies keyed by ``request_id``, as a scoring service would write them."""
    k = F.col("row_id") + strategy_ord()
    once = requests.select("request_id", stub_response(k).alias("response"), (k % 8).alias("_c"))
    # Some are answered again, with nothing, by an empty reply, or with bare numbers under
    # the header, in a text that sorts before the one with scores.
    bare = F.when(F.col("_c") == 0, F.lit("")).when(F.col("_c").isin(3, 5), F.lit(BARE_REPLY))
    again = once.where(F.col("_c").isin(0, 1, 3, 5, 6)).withColumn("response", bare)
    return once.unionByName(again).drop("_c")


def catalog_lines(pages: DataFrame) -> DataFrame:
    """CSV lines of a catalogue over the pages: quoted and plain cells, doubled
    quotes, commas, surrounding spaces, empty cells."""
    pid, url = _s(F.col("page_id")), F.col("url")
    name = (
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit('"Set ""'), pid, F.lit('"", a"')))
        .when(F.col("page_id") % 4 == 1, F.concat(F.lit(" DS"), pid, F.lit(" ")))
        .when(F.col("page_id") % 4 == 2, F.lit(""))
        .otherwise(F.lit("NA"))
    )
    return pages.select("page_id", F.concat(name, F.lit(","), F.lit('"'), url, F.lit('",x')).alias("value"))


def catalog_file_lines(pages: DataFrame, region: DataFrame) -> DataFrame:
    """Physical lines of catalogue files, as ``file, block, at, line``: a record per page
    (cells over several lines, stray quotes, blank lines, missing and surplus cells), a
    file per hundred pages and a split per ten; a last file whose quote stays open."""
    pid, url = _s(F.col("page_id")), F.col("url")
    c, cr = F.col("page_id") % 6, F.lit("\r")
    lines = (
        F.when(c == 0, F.array(F.concat(F.lit('"Set ""'), pid, F.lit('"",'), cr), F.concat(F.lit('part two",'), url, F.lit(",x"), cr)))
        .when(c == 1, F.array(F.concat(F.lit('5" disk '), pid, F.lit(","), url, F.lit(",x"))))
        .when(c == 2, F.array(cr, F.concat(F.lit('NA,"'), url, F.lit('",'), cr)))
        .when(c == 3, F.array(F.concat(F.lit("D"), pid, F.lit(","), url, F.lit(",x,y"))))
        .when(c == 4, F.array(F.lit('"a'), F.lit(""), F.concat(F.lit("b "), pid, F.lit('","'), url, F.lit('"'))))
        .otherwise(F.array(F.concat(F.lit('"D"'), pid)))
    )
    file = F.concat(F.lit("f"), F.lpad(_s(F.floor(F.col("page_id") / 100)), 12, "0"))
    block = F.floor(F.col("page_id") % 100 / 10)
    body = pages.select(file.alias("file"), block.alias("block"), "page_id", F.posexplode(lines).alias("k", "line"))
    body = body.select("file", "block", (F.col("page_id") * 10 + F.col("k")).alias("at"), "line")
    key = F.col("r_regionkey").cast("bigint")
    last = region.select(
        F.lit("z").alias("file"), key.alias("block"), key.alias("at"),
        F.when(key == 1, F.lit('"open,http://open/')).otherwise(F.concat("r_name", F.lit(",http://region/"))).alias("line"),
    )
    every = body.unionByName(last)
    heads = every.groupBy("file").agg(F.min("block").alias("block")).select(
        "file", "block", F.lit(-1).cast("bigint").alias("at"), F.lit("\ufeffDataset Name,Website Link,x").alias("line")
    )
    return heads.unionByName(every)


def completion_bodies(replies: DataFrame) -> DataFrame:
    """The same replies wrapped as chat-completion JSON bodies."""
    body = F.to_json(
        F.struct(F.array(F.struct(F.struct(F.col("response").alias("content")).alias("message"))).alias("choices"))
    )
    return replies.select("conv_id", "turn", body.alias("body"))
