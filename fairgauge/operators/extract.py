"""Page metadata extraction, EX-1 … EX-9, as column expressions.

One narrow projection per page: no shuffle and no Python. The wide ``html``
column is consumed here and never leaves the scan stage; what comes out is a
record of a few KB (the text snippet is capped at 2,000 code points).

Regex extraction instead of a DOM. Known divergences from a DOM parser: an
attribute value whose quote never closes, CDATA sections, and markup or a comment
inside ``<title>`` (reported as the ``nested_title`` error, a parser-dependent
case).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairgauge.functions import patterns as P
from fairgauge.functions.text import let, strip, unescape, unquote

#: Error codes for pages that the scraping step could not use, in the order
#: they are checked (the title is examined before the description).
ERROR_CODES = ("no_page", "empty_title", "nested_title", "meta_without_content")

#: Description text an error record carries: the message the scripts'
#: exception would print where that is deterministic.
ERROR_MESSAGES = {
    "no_page": "no crawled page for this link",
    "empty_title": "'NoneType' object has no attribute 'strip'",
    "nested_title": "'NoneType' object has no attribute 'strip'",
    "meta_without_content": "'content'",
}

SCRAPED_FIELDS = (
    "title", "description", "license_info", "file_formats",
    "download_links", "raw_text_snippet",
)


def collapse_nodes(decoded: Column) -> Column:
    """Split at the node separators, strip every node, drop the empty ones,
    join with one space: ``get_text(" ", strip=True)`` on marked text."""
    nodes = F.transform(F.split(decoded, P.NODE_SEP), strip)
    return F.translate(F.array_join(F.filter(nodes, lambda t: t != ""), " "), P.HELD, P.NODE_SEP)


def hide_blocks(html: Column) -> Column:
    """Comments, script, style and template bodies replaced by a marker. A
    separator character of the page's own is held back as a noncharacter."""
    return F.regexp_replace(F.translate(html, P.NODE_SEP, P.HELD), P.HIDDEN_RE, P.HIDDEN_MARK)


def mark_nodes(clean: Column) -> Column:
    """Every tag (and hidden-block marker) becomes a node separator."""
    return F.regexp_replace(clean, P.TAG_RE, P.NODE_SEP)


def visible_text(html: Column) -> Column:
    """EX-3: ``get_text(" ", strip=True)`` — text nodes stripped, empty ones
    dropped, joined by one space. Tags and hidden blocks become separators,
    references are decoded, then :func:`collapse_nodes`."""
    return collapse_nodes(unescape(mark_nodes(hide_blocks(html))))


def license_cues(low_text: Column) -> Column:
    """EX-4: keywords found in the lower-cased text, in keyword order, joined
    by ', ' ('' when none)."""
    return F.concat_ws(", ", *[F.when(low_text.contains(k.lower()), F.lit(k)) for k in P.LICENSE_KEYWORDS])


def file_formats(html: Column) -> Column:
    """EX-5: extensions named anywhere in the raw HTML, distinct (case kept),
    sorted — the scripts' set order is unspecified, sorting pins it."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit(P.FORMAT_RE_JAVA), 1)))


def attribute(tag: Column, name: str) -> Column:
    """Raw value of a tag's first attribute called ``name`` ('' if it has none),
    NULL without such an attribute. Attributes are read from left to right, so
    text inside another one's value is never taken for one."""
    body = F.regexp_replace(tag, P.TAG_HEAD_RE, "")
    every = F.regexp_extract_all(body, F.lit(P.ATTRIBUTE_RE), 0)
    named = F.filter(every, lambda a: F.lower(F.regexp_extract(a, P.ATTRIBUTE_RE, 1)) == name)
    return unquote(F.regexp_extract(F.get(named, 0), P.ATTRIBUTE_RE, 2))


def raw_hrefs(clean: Column) -> Column:
    """EX-6, first half: href values of ``<a>`` tags in document order."""
    tags = F.regexp_extract_all(clean, F.lit(P.ANCHOR_TAG_RE), 0)
    return F.array_compact(F.transform(tags, lambda t: attribute(t, "href")))


def download_links(hrefs: Column) -> Column:
    """EX-6, second half: decoded hrefs whose lower-cased value contains a data
    extension; duplicates kept."""
    decoded = F.transform(hrefs, lambda h: F.translate(unescape(h), P.HELD, P.NODE_SEP))
    return F.filter(decoded, lambda h: F.lower(h).rlike(P.DOWNLOAD_LINK_RE))


def _or_default(arr: Column, default: str) -> Column:
    return F.when(F.size(arr) == 0, F.array(F.lit(default))).otherwise(arr)


def with_scraped(df: DataFrame, html: str = "html") -> DataFrame:
    """Add the scraped record's columns plus ``scrape_ok``/``scrape_error``.

    Fields are NULL on error rows; the dialect's sentinels are filled in by
    :func:`fill_error_record` once the strategy is known. Work is staged so
    that every regex pass over the HTML runs once per page (raw passes, then the
    fields), and every text is decoded in a column of its own, so that a query
    for the title alone decodes nothing else.
    """
    keep = [c for c in df.columns if c != html]
    h = F.col(html)
    raw = df.select(
        *keep, h.isNull().alias("_no_page"),
        hide_blocks(h).alias("_clean"),
        file_formats(h).alias("_formats"),
    )
    clean = F.col("_clean")
    parts = raw.select(
        *keep, "_no_page", "_formats",
        mark_nodes(clean).alias("_marked"),
        F.regexp_extract(clean, P.TITLE_RE, 1).alias("_title_in"),
        clean.rlike(P.TITLE_OPEN_RE).alias("_has_title"),
        F.get(F.filter(F.regexp_extract_all(clean, F.lit(P.META_TAG_RE), 0),
                       lambda t: attribute(t, "name") == "description"), 0).alias("_desc_tag"),
        raw_hrefs(clean).alias("_hrefs"),
    )
    desc_tag = F.col("_desc_tag")
    decoded = parts.select(
        *keep, "_no_page", "_formats", "_title_in", "_has_title", "_desc_tag",
        "_hrefs",
        unescape(F.col("_marked")).alias("_text_dec"),
        unescape(F.translate(F.col("_title_in"), P.HELD, P.NODE_SEP)).alias("_title_dec"),
        let(attribute(desc_tag, "content"), lambda c: unescape(F.translate(c, P.HELD, P.NODE_SEP))).alias("_content_dec"),
    )
    title_in, has_title = F.col("_title_in"), F.col("_has_title")
    error = (
        F.when(F.col("_no_page"), "no_page")
        .when(has_title & (title_in == ""), "empty_title")
        .when(has_title & title_in.rlike(P.NESTED_MARKUP_RE), "nested_title")
        .when(desc_tag.isNotNull() & F.col("_content_dec").isNull(), "meta_without_content")
    )
    texts = decoded.select(
        *keep, "_formats", "_has_title", "_desc_tag", "_title_dec", "_content_dec",
        error.alias("scrape_error"),
        collapse_nodes(F.col("_text_dec")).alias("_text"),
        download_links(F.col("_hrefs")).alias("_links"),
    )
    text = F.col("_text")
    cues = texts.select(
        *keep, "_formats", "_has_title", "_desc_tag", "_title_dec", "_content_dec", "scrape_error", "_links",
        license_cues(F.lower(text)).alias("_cues"),
        F.substring(text, 1, 2000).alias("_snippet"),
    )
    ok = F.col("scrape_error").isNull()
    cues_col = F.col("_cues")
    fields = [
        F.when(~F.col("_has_title"), P.NOT_FOUND).otherwise(strip(F.col("_title_dec"))).alias("title"),
        F.when(F.col("_desc_tag").isNull(), P.NOT_FOUND).otherwise(strip(F.col("_content_dec"))).alias("description"),
        F.when(cues_col == "", P.NOT_DETECTED).otherwise(cues_col).alias("license_info"),
        _or_default(F.col("_formats"), P.NONE_DETECTED).alias("file_formats"),
        _or_default(F.col("_links"), P.NONE_DETECTED).alias("download_links"),
        F.col("_snippet").alias("raw_text_snippet"),
    ]
    return cues.select(
        *keep, "scrape_error", ok.alias("scrape_ok"),
        *[F.when(ok, f).alias(name) for f, name in zip(fields, SCRAPED_FIELDS)],
    )


def fill_error_record(df: DataFrame, dialect: Column) -> DataFrame:
    """EX-9: the error record. Formats and links are ``['N/A']`` in dialect A
    and empty lists in dialect B."""
    bad = ~F.col("scrape_ok")
    na_list = F.when(dialect == "A", F.array(F.lit(P.ERROR_VALUE))).otherwise(F.array().cast("array<string>"))
    msg = F.create_map(*[x for k, v in ERROR_MESSAGES.items() for x in (F.lit(k), F.lit(v))])
    return (
        df.withColumn("title", F.when(bad, P.ERROR_TITLE).otherwise(F.col("title")))
        .withColumn("description", F.when(bad, msg[F.col("scrape_error")]).otherwise(F.col("description")))
        .withColumn("license_info", F.when(bad, P.ERROR_VALUE).otherwise(F.col("license_info")))
        .withColumn("file_formats", F.when(bad, na_list).otherwise(F.col("file_formats")))
        .withColumn("download_links", F.when(bad, na_list).otherwise(F.col("download_links")))
        .withColumn("raw_text_snippet", F.when(bad, "").otherwise(F.col("raw_text_snippet")))
    )

