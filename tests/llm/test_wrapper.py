from __future__ import annotations

import random

import pytest

from fairgauge.llm import wrapper
from fairgauge.llm.wrapper import extract_main_text, main_text
from llm_tables import prose

SCHEMA = "page_id long, url string, html string, id string, host string, tree string, text string, nodes string"


def extract(spark, rows):
    pages = spark.createDataFrame([(i, u, h, "i", "h", "t", "x", "n") for i, u, h in rows], SCHEMA)
    out = wrapper.extract_main_text(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert all(r.n_chars == len(r.text) for r in got)
    return got


def size(t):
    return 1 + sum(map(size, t[1]))


def best_match(a, b):
    """Simple tree matching by its definition, without tables."""
    def lists(x, y):
        if not x or not y:
            return 0
        most = max(lists(x[1:], y), lists(x, y[1:]))
        return max(most, best_match(x[0], y[0]) + lists(x[1:], y[1:])) if x[0][0] == y[0][0] else most
    return 1 + lists(a[1], b[1])


def test_simple_tree_matching():
    rnd = random.Random(4)

    def tree(depth):
        return [rnd.choice("abc"), [tree(depth - 1) for _ in range(rnd.randrange(4))] if depth else []]

    for _ in range(200):
        a, b = ["r", tree(2)[1]], ["r", tree(2)[1]]
        n, pairs = wrapper.match(a, b)
        assert n == best_match(a, b)
        assert wrapper.match(a, a)[0] == size(a)
        both = wrapper.merge(a, b, pairs)
        assert size(both) == size(a) + size(b) - n


def news(rnd, k):
    body = [prose(rnd, rnd.randrange(5, 40)) for _ in range(rnd.randrange(1, 6))]
    page = f"""<!doctype html><html><head><title>{prose(rnd, 3)}</title><script>var a="<p>no</p>";</script><style>p{{}}</style></head>
    <body class="page"><header><a href=/>Home</a> The Daily</header><nav><ul>{''.join(f'<li><a href="/{prose(rnd, 1)}">{prose(rnd, 1)}</a>' for _ in range(5))}</ul></nav>
    <!-- <p>hidden</p> --><div id=content-{k}><div class="intro">Read by millions of people</div><h1>{prose(rnd, 4)} &amp; co {k}</h1>
    <div class='byline'>By {prose(rnd, 2)}</div>{''.join(f'<p>{b}' for b in body)}<blockquote>Quote&nbsp;&eacute;   {k}</blockquote><div class="advert">Buy {k}</div>
    <form action=x><input name=q><label>Search {k}</label></form><section id="comments"><p>Reader {prose(rnd, 4)}</p></section></div>
    <div class="sidebar"><p>Most read {prose(rnd, 3)}</p></div><div class="cookie-notice">We use cookies {k}</div><footer>&copy; {prose(rnd, 2)}</footer></body></html>"""
    return page, body


def test_a_host_without_article_elements(spark):
    rnd = random.Random(8)
    pages = [news(rnd, k) for k in range(30)]
    got = {r.page_id: r.text for r in extract(spark, [(k, f"https://news.example/{k}", p) for k, (p, _) in enumerate(pages)])}
    for k, (page, body) in enumerate(pages):
        lines = got[k].split("\n")
        assert lines[0].endswith(f"& co {k}") and lines[1].startswith("By ") and lines[2:-1] == body
        assert lines[-1] == f"Quote é {k}"


def test_articles_tag_soup_and_awkward_rows(spark):
    html = [
        ('<article><h1>T &lt;i&gt; &#x41;&#66;</h1><p><b>one\n two<br><p>three</article><footer>f</footer>', "T <i> AB\none two\nthree"),
        ('<body><main><p class=it\'s>Body</p><p title="a > b">x<i>y</i>z</p></main><aside>no</aside>', "Body\nxyz"),
        ('<article><header><h1>Head</h1></header><p>a<p>b<div class="comments">no</div><ul><li>c<li>d</ul></article>', "Head\na\nb\nc\nd"),
        ('<article>a < b and <3 <a href="/a.csv"">click</a> more<script>x</script', "a < b and <3 click more"),
        ("plain text only &copy 2020 &am", "plain text only © 2020 &am"),
        ("<article><p>" + "long " * 30_000 + "</article>", ("long " * 30_000).strip()),
        ("<div>" * 500 + "deep" + "</div>" * 500, "deep"),
        ("<a title='" * 2000, None), ("", ""), (None, ""), ("<nav>x</nav>", ""), ("<", "<"),
    ]
    rows = [(k, f"http://h{k}.example/", h) for k, (h, _) in enumerate(html)]
    rows += [(None, None, "<p>no url</p>"), (100, "no host", "<p>no host</p>"), (101, "http://h0.example/x", html[0][0])]
    rows += [(0, "http://h0.example/", html[0][0])]
    got = extract(spark, rows)
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    for k, (_, want) in enumerate(html):
        assert want is None or texts[k] == want, k
    assert (texts[None], texts[100], texts[101]) == ("no url", "no host", html[0][1])


def test_copies_do_not_make_a_template(spark):
    same = "<html><body><div><p>Exactly this story again</p></div></body></html>"
    rows = [(k, f"http://one.example/{k}", same) for k in range(50)]
    assert {r.text for r in extract(spark, rows)} == {"Exactly this story again"}


def test_inline_markup_and_a_headline_outside_the_body_container(spark):
    rnd, rows, want = random.Random(5), [], {}
    for k in range(12):
        title, lead, text, item, cell = (prose(rnd, n) for n in (3, 4, 120, 3, 2))
        rows.append((k, f"http://inline.example/{k}", f"""<html><body><div class=top>Daily paper</div><h1>{title}</h1><div class=lead>{lead}</div>
            <div class=text><p>{text} <a href=/>link {k}</a> <b>bold {k}</b></p><h2>Head {k}</h2><ul><li>{item}</li></ul>
            <table><tr><td>{cell}</td></tr></table></div><div class=legal>All rights reserved</div></body></html>"""))  # fmt: skip
        want[k] = "\n".join([title, lead, f"{text} link {k} bold {k}", f"Head {k}", item, cell])
    assert {r.page_id: r.text for r in extract(spark, rows)} == want


def test_text_after_deep_elements():
    def text(page):
        return wrapper.main_text(page, None, set(), 0)

    deep = "<div>" * 100 + "deep<aside>no<div>no</div></aside><nav>no</nav><div class=ad>no</div>low" + "</div>" * 100
    assert text(f"<div>out<article><h1>T</h1>{deep}<p>after</p></article>out</div>") == "T\ndeep\nlow\nafter"
    assert text(f"{deep}<p>after</p>") == "deep\nlow\nafter"
    assert text("out" + "<div>" * 100 + "<article>a<p>b</article>" + "</div>" * 100 + "out") == "a\nb"
    assert text("<span>" * 200_000 + "x" + "</b><p>" * 50_000 + "y") == "x\ny"


def test_every_layout_of_a_host_is_aligned(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "MERGED_TREES", 3, raising=False)  # several rounds
    rnd, rows, want = random.Random(6), [], {}
    for k in range(120):
        layout, text = "abcdefghijkl"[k % 12], prose(rnd, 30)
        parts = [f"<p>{text}</p>", f"<div class=about{layout}>All about us, layout {layout}</div>"]
        # An order of its own, too.
        rows.append((k, f"http://many.example/{k}", f"<body><div class=box-{layout}>{''.join(parts[:: 1 if k % 5 else -1])}</div></body>"))
        want[k] = text
    assert {r.page_id: r.text for r in extract(spark, rows)} == want


def test_a_constant_block_longer_than_the_articles(spark):
    rnd, rows, want = random.Random(7), [], {}
    legal = "No part of this may be copied without our leave. " * 20
    for k in range(20):
        want[k] = prose(rnd, 25)
        rows.append((k, f"http://legal.example/{k}", f"<body><div class=story><p>{want[k]}</p></div><div class=about>{legal}</div></body>"))
    assert {r.page_id: r.text for r in extract(spark, rows)} == want


def test_empty(spark):
    assert extract(spark, []) == []


NAMED = ["content with-sidebar", "post comments-open", "page-no-banner", "col has-ads", "related-work"]


@pytest.mark.parametrize("name", NAMED)
def test_a_word_in_a_class_empties_no_page(spark, name):
    rnd = random.Random(1)
    rows = []
    for k in range(12):
        body = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) + str(rnd.randrange(99)) for _ in range(30))
        page = f'<body><div class="nav-menu"><a>Home</a></div><div class="{name}"><p>{body}</p></div><div class="site-footer">Imprint</div></body>'
        rows.append((k, "http://named.example/x", page, body))
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()}
    assert got == {k: body for k, _, _, body in rows}


@pytest.mark.parametrize("element", ['<h2 class="related-work">', '<p class="notice-period">', '<div class="social-security">'])
def test_compound_names_inside_an_article(element):
    page = f"<article><p>one</p>{element}two</{element[1:].split(' ')[0]}><p class='share'>three</p></article>"
    assert main_text(page, None, set(), 0) == "one\ntwo"


@pytest.mark.parametrize("name,gone", [("sidebar", True), ("sidebar-left", True), ("site-footer", True), ("main-nav", True), ("cookie-banner", True),
                                       ("ad", True), ("adverb", False), ("with-sidebar", False), ("notice-period", False), ("menu-driven", False)])
def test_names(name, gone):
    page = f'<body><div class="{name}">x</div><p>kept</p></body>'
    assert main_text(page, None, set(), 0) == ("kept" if gone else "x\nkept")


def test_a_page_with_nothing_but_named_elements_keeps_its_text():
    assert main_text('<body><nav>menu</nav><div class="popup"><p>all there is</p></div></body>', None, set(), 0) == "all there is"


def test_constant_headings_of_articles_stay(spark):
    rows = []
    for k in range(8):
        page = (f"<body><article><h1>Title {k}</h1><h2>Summary</h2><p>sum {k * 7}</p><p class='licence'>Free to use.</p><h2>References</h2>"
                f"<ul><li>ref {k * 3}</li></ul><div class='tail'>Thanks for reading.</div></article></body>")  # fmt: skip
        rows.append((k, "http://articles.example/", page))
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {
        k: f"Title {k}\nSummary\nsum {k * 7}\nFree to use.\nReferences\nref {k * 3}" for k in range(8)}
