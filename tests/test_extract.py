"""Extraction (EX-1 … EX-9) on hand-written HTML; expected values are read
off the scraping step's behaviour (FIXTURES.md §3)."""

import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from fairgauge.operators.extract import fill_error_record, visible_text, with_scraped

CASES = [
    # html, title, description, links, error
    (
        "<html><head><title> A &amp; B </title><META content='x > y' NAME='description'></head><body>"
        "<a href='/a.csv'>1</a><A class=k HREF=/b.zip>2</A><a href=\"/c.json?x=1&amp;y\">3</a>"
        "<a href=\"/d.pdf\">4</a><!-- <a href=\"/e.csv\">n</a> --><script>var z='<a href=\"/f.csv\">q</a>'</script>"
        "</body></html>",
        "A & B", "x > y", ["/a.csv", "/b.zip", "/c.json?x=1&y"], None,
    ),
    ("<title></title><p>x", None, None, None, "empty_title"),
    ('<p>no title</p><meta name="Description" content="c">', "Not found", "Not found", ["None detected"], None),
    ('<title> </title><meta name=description content="  d ">', "", "d", ["None detected"], None),
    ('<title>t</title><meta name="description">', None, None, None, "meta_without_content"),
    ('<title>t</title><meta name="description" content="">', "t", "", ["None detected"], None),
    (
        '<title>t</title><meta property="og:description" content="og"><a data-href="/x.csv" href="/y.xml">k</a>',
        "t", "Not found", ["/y.xml"], None,
    ),
    ("<title>T<b>x</b></title>a", None, None, None, "nested_title"),
    ("<title>a<!-- c -->b</title>", None, None, None, "nested_title"),
    ("<!-- <title>x</title> --><script>t='<title>y</title>'</script><p>p</p>", "Not found", "Not found", ["None detected"], None),
    ("", "Not found", "Not found", ["None detected"], None),
    (None, None, None, None, "no_page"),
]


@pytest.fixture(scope="module")
def scraped(spark):
    rows = [(i, h) for i, (h, *_rest) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, html string")
    return {r["id"]: r for r in with_scraped(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_html_case(scraped, i):
    _, title, desc, links, err = CASES[i]
    r = scraped[i]
    assert r["scrape_error"] == err
    assert r["scrape_ok"] == (err is None)
    if err is None:
        assert r["title"] == title
        assert r["description"] == desc
        assert r["download_links"] == links
    else:
        assert r["title"] is None and r["download_links"] is None


TEXT_CASES = [
    ("<title>T</title>a<b>b</b>c<br> d \n e <style>p{}</style>&nbsp;f<!-- z -->g", "T a b c d \n e f g"),
    ("<!DOCTYPE html><p>  x  </p>\n\n<p>y</p><script>s</script><template>t</template>", "x y"),
    ("a < b &amp;lt; c", "a < b &lt; c"),
    ("&eacute;t&#233; &#x27;q&#39; &notit; &amp &copy 2020", "été 'q' ¬it; & © 2020"),
    ("<p class=it's>Body</p><p>a\x01b</p>", "Body a\x01b"),
    ('<a href="/a.csv"">click here</a> then <b title=">">x</b>', "click here then x"),
    ("&#00000000000000000000065;&#x000000000000000000000041;", "AA"),
]


@pytest.mark.parametrize("html,expected", TEXT_CASES)
def test_visible_text(spark, html, expected):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(visible_text(F.col("html")).alias("t")).first()["t"] == expected


LICENSE_CASES = [
    ("<p>Released as <i>CC-BY</i> or public domain</p>", "CC-BY, public domain"),
    ("<p>Public Domain, creative commons LICENSE</p>", "license, public domain, creative commons"),
    ('<p>CC BY 4.0</p><a href="https://creativecommons.org/">x</a>', "Not detected"),
]


@pytest.mark.parametrize("html,expected", LICENSE_CASES)
def test_license(spark, html, expected):
    df = spark.createDataFrame([(html,)], "html string")
    assert with_scraped(df).first()["license_info"] == expected


FORMAT_CASES = [
    ("a.Json .XLSX .xls .jsonp", ["Json", "XLSX", "json", "xls"]),
    ("x.csv y.CSV z.csv", ["CSV", "csv"]),
    ("nothing here", ["None detected"]),
]


@pytest.mark.parametrize("html,expected", FORMAT_CASES)
def test_formats(spark, html, expected):
    df = spark.createDataFrame([(html,)], "html string")
    assert with_scraped(df).first()["file_formats"] == expected


def test_snippet_is_first_2000_code_points(spark):
    body = "é" * 2500
    df = spark.createDataFrame([(f"<p>{body}</p>",)], "html string")
    assert with_scraped(df).first()["raw_text_snippet"] == "é" * 2000


def test_error_record_by_dialect(spark):
    df = spark.createDataFrame([(None, "A"), (None, "B"), ("<title>t</title>", "A")], "html string, dialect string")
    rows = fill_error_record(with_scraped(df), F.col("dialect")).collect()
    a, b, ok = rows
    assert (a["title"], a["license_info"], a["file_formats"], a["download_links"], a["raw_text_snippet"]) == (
        "Error scraping website", "N/A", ["N/A"], ["N/A"], "")
    assert (b["file_formats"], b["download_links"]) == ([], [])
    assert ok["title"] == "t" and ok["file_formats"] == ["None detected"]


TAG_CASES = [
    # html, links, description
    ('<a href="/a.csv"">click here</a><a href="/b.csv">', ["/a.csv", "/b.csv"], None),
    ("<a title=\"see href='/x.csv' here\" href=\"/y.html\">", ["None detected"], None),
    ('<a data-href="/n.csv" hreflang=/m.csv>x</a>', ["None detected"], None),
    ('<a href="/first.csv" href="/second.csv">x</a><A HREF=/u.json>', ["/first.csv", "/u.json"], None),
    ("<a href='/q\x01r.csv'>x</a>", ["/q\x01r.csv"], None),
    ('<a class=x\nhref = "/s p.zip">x</a><a href>y</a>', ["/s p.zip"], None),
    ("<meta content=\" name='description' \" property=x><meta name=description content=real>", ["None detected"], "real"),
    ('<meta name="description"content="close">', ["None detected"], "close"),
]


@pytest.mark.parametrize("html,links,description", TAG_CASES)
def test_attributes_are_read_from_left_to_right(spark, html, links, description):
    r = with_scraped(spark.createDataFrame([(html,)], "html string")).first()
    assert r["download_links"] == links
    assert r["description"] == (description or "Not found")


def test_well_formed_tags_against_the_standard_parser(spark):
    rnd = random.Random(5)
    pages = []
    for _ in range(150):
        page = ""
        for _ in range(rnd.randrange(1, 6)):
            attributes = [
                rnd.choice(["href", "HREF", "title", "data-x", "class"]) + rnd.choice(["=", " = "])
                + rnd.choice(['"%s"', "'%s'"]) % rnd.choice(["/a.csv", "x > y.zip", "href=/q.json", "&amp;.xml", "name=description", " "])
                for _ in range(rnd.randrange(4))
            ]
            names = [a.split("=")[0].strip().lower() for a in attributes]
            attributes = [a for k, a in enumerate(attributes) if names[k] not in names[:k]]
            page += "<a " + " ".join(attributes) + ">" + rnd.choice(["x", "a.csv", " it's ", "&lt;"]) + "</a>"
        pages.append(page)

    class Reader(HTMLParser):
        def handle_starttag(self, tag, attrs):
            self.links += [v for k, v in attrs if k == "href" and re.search(r"\.(csv|json|zip|xlsx|xml)", v.lower())]

        def handle_data(self, data):
            self.texts.append(data.strip())

    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    for r in with_scraped(rows).collect():
        reader = Reader()
        reader.links, reader.texts = [], []
        reader.feed(pages[r["i"]])
        reader.close()
        assert r["download_links"] == (reader.links or ["None detected"]), pages[r["i"]]
        assert r["raw_text_snippet"] == " ".join(t for t in reader.texts if t), pages[r["i"]]


def test_long_attributes_and_unclosed_blocks(spark):
    """A 200 KB unquoted attribute once overflowed Java's regex stack and
    killed the executor; unclosed comments and scripts run to the end."""
    html = (
        "<p><a href=" + "x" * 200_000 + ".csv>d</a><img src=data:image/png;base64," + "A" * 300_000
        + "></p><title>t</title><p>after</p><!-- never closed " + "c" * 100_000
    )
    r = with_scraped(spark.createDataFrame([(html,)], "html string")).first()
    assert r["title"] == "t"
    assert r["raw_text_snippet"] == "d t after"
    assert r["download_links"][0].endswith("x.csv")
