"""Prompt text: fixed blocks by checksum, list text (FN-9) against Python's
own ``repr``, and whole messages against plain Python string assembly."""

import hashlib

import pytest
from pyspark.sql import functions as F

from fairgauge.functions.text import py_list_repr
from fairgauge.operators.prompts import envelope, request_lines, with_requests
from fairgauge.plans import strategies as S


@pytest.mark.parametrize("text,chars,md5", [
    (S.RUBRIC, 1337, "7c0301d7cf01538064d7357dfb8380d1"),
    (S.EXAMPLE_EPA, 719, "0867f69a9ed1f63220f7b6f0c62023c1"),
    (S.EXAMPLE_NE, 394, "20187a6b7d5125eb21070db71748044a"),
    (S.EXAMPLES_FEW_SHOT, 1075, "6e34c1480cdf79dbb8716e1db5568418"),
])
def test_fixed_blocks(text, chars, md5):
    assert len(text) == chars
    assert hashlib.md5(text.encode()).hexdigest() == md5


def test_rubric_maxima_match_principles():
    for i, (name, _, mx) in enumerate(S.PRINCIPLES, start=1):
        assert f"### {i}. {name} (Max: {mx})" in S.RUBRIC
    assert sum(m for _, _, m in S.PRINCIPLES) == 42


LISTS = [[], ["a", "b"], ["it's"], ['q"x'], ["both ' and \""], ["back\\slash"], ["tab\tnew\nline\r"], ["None detected"]]


def test_list_text_equals_python(spark):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(LISTS)], "i int, l array<string>")
    got = {r["i"]: r["t"] for r in df.select("i", py_list_repr(F.col("l")).alias("t")).collect()}
    for i, l in enumerate(LISTS):
        assert got[i] == repr(l)


RECORDS = [
    # dataset_name, website_link, title, description, license, formats, links, snippet, ok
    ("UCMR5", "https://example.org/a#3", "T", "D", "CC-BY", ["csv", "pdf"], ["/a.csv"], "text " * 3, True),
    (None, None, None, None, None, None, None, None, False),
    ("N'ame", "https://example.org/b ", "it's", "q\"d", "Not detected", ["None detected"], ["None detected"], "", True),
]


def _expected(rec, strategy):
    name, link, title, desc, lic, formats, links, snippet, ok = rec
    s = next(x for x in S.STRATEGIES if x["strategy"] == strategy)
    a = s["dialect"] == "A"
    if not ok:
        title, desc, lic, snippet = "Error scraping website", "no crawled page for this link", "N/A", ""
        formats = links = (["N/A"] if a else [])
    name = "nan" if name is None else name
    link = "nan" if link is None else link
    if a:
        return S.RUBRIC + (
            f"\n### Extracted Website Content\n- Title: {title}\n- Description: {desc}\n- License: {lic}\n"
            f"- File Formats: {formats}\n- Download Links: {links}\n- Raw Page Text Snippet:\n{snippet}\n"
        ) + S.INSTRUCTION_A.format(dataset_name=name, website_link=link)
    return S.RUBRIC + s["examples"] + (
        f"\n### Extracted Website Content for LLM Evaluation\n- Title: {title}\n- Description: {desc}\n"
        f"- License Detected: {lic}\n- File Formats: {', '.join(formats)}\n- Downloadable Links: {links}\n"
        f"- Raw Page Text Snippet:\n{snippet}\n"
    ) + S.INSTRUCTION_B.format(dataset_name=name, website_link=link)


def test_user_messages_equal_python_assembly(spark):
    from fairgauge.operators.extract import fill_error_record
    from fairgauge.operators.joins import fan_out

    rows = [(i, *r[:-1], r[-1], None if r[-1] else "no_page") for i, r in enumerate(RECORDS)]
    df = spark.createDataFrame(rows, "row_id long, dataset_name string, website_link string, title string, "
                                     "description string, license_info string, file_formats array<string>, "
                                     "download_links array<string>, raw_text_snippet string, scrape_ok boolean, "
                                     "scrape_error string")
    strats = S.strategies()
    reqs = with_requests(fill_error_record(fan_out(df, strats), F.col("dialect")), strats).collect()
    assert len(reqs) == len(RECORDS) * 4
    for r in reqs:
        assert r["user_content"] == _expected(RECORDS[r["row_id"]], r["strategy"]), (r["row_id"], r["strategy"])
        s = next(x for x in S.STRATEGIES if x["strategy"] == r["strategy"])
        assert r["system_content"] == s["system"] and r["max_tokens"] == s["max_tokens"]
    assert len({r["request_id"] for r in reqs}) == len(reqs)

    lines = request_lines(with_requests(fill_error_record(fan_out(df, strats), F.col("dialect")), strats))
    body = spark.read.json(lines.rdd.map(lambda r: r.value)).collect()
    assert len(body) == len(reqs)
    one = body[0]["request"]
    assert one["model"] == "gpt-4o" and one["temperature"] == 0.2
    assert [m["role"] for m in one["messages"]] == ["system", "user"]
    env = envelope(with_requests(fill_error_record(fan_out(df, strats), F.col("dialect")), strats))
    assert env.schema["request"].dataType.simpleString().startswith("struct<model:string,messages:array")
