"""FN-1, FN-2 and FN-9 against Python itself: ``str.strip``, the stdlib's
reference decoding and ``repr``."""

import html
import html.entities
import random

import pytest
from pyspark.sql import functions as F

from fairgauge.functions.text import py_list_repr, strip, unescape


CASES = [
    "", "plain", "a & b", "a&b", "&", "&&", "x&", "&;", "&#;", "&#x;", "&#xZZ;", "&unknown;", "&amp",
    "&amp;", "&amp;lt;", "&#38;lt;", "&AMP;", "&lt;&gt;&quot;&apos;&nbsp;", "&Eacute;t&eacute;", "&notit;", "&not;",
    "&#0;", "&#x0;", "&#9;", "&#13;", "&#128;", "&#x80;", "&#x81;", "&#159;", "&#55296;", "&#xDFFF;", "&#1114111;",
    "&#1114112;", "&#99999999999999999999;", "&#x110000;", "&#x0000041;", "&#0065;", "&#x1F600;", "&#65534;",
    "&#xFDD0;", "&#1;", "&#127;", "&#x2028;", "&NotNestedGreaterGreater;", "&fjlig;", "&#8217;s", "a&#160;b",
    "&#" + "0" * 40 + "65;", "&#x" + "0" * 30 + "41", "&copy 2020", "&ampx &ampamp;", "&nbsp", "&notin &notinx &notin;", "&#65 &#66x",
    "&Aacutee", "&AMP&LT", "&amp=1&copy=2", "&frac1 &frac12 &frac123;",
]


def _random_cases(n=300, seed=7):
    rnd = random.Random(seed)
    names = list(html.entities.html5)
    parts = ["&", ";", "#", "x", "a", "1", "0", " ", "\t", "é", "&amp;", "&#"]
    out = []
    for _ in range(n):
        pieces = []
        for _ in range(rnd.randint(1, 8)):
            r = rnd.random()
            if r < 0.3:
                pieces.append("&" + rnd.choice(names))
            elif r < 0.5:
                pieces.append(f"&#{rnd.randint(0, 0x11FFFF)};" if rnd.random() < 0.5 else f"&#x{rnd.randint(0, 0x11FFFF):X};")
            else:
                pieces.append("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))))
        out.append("".join(pieces))
    return out


def test_unescape_equals_stdlib(spark):
    cases = CASES + _random_cases()
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s string")
    got = {r["i"]: r["d"] for r in df.select("i", unescape(F.col("s")).alias("d")).collect()}
    bad = [(c, got[i], html.unescape(c)) for i, c in enumerate(cases) if got[i] != html.unescape(c)]
    assert not bad, bad[:5]


def test_list_text_equals_python(spark):
    rnd = random.Random(3)
    chars = "ab'\"\\\n\t\r\x00\x01\x1f\x7f\x80\xa0\xad\u200b\u2028\u3000\ufeff\ue000\U0001f600\U000e0001é日 "
    lists = [["", "a"], []] + [["".join(rnd.choice(chars) for _ in range(rnd.randrange(9))) for _ in range(3)] for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, l array<string>")
    for r in df.select("i", py_list_repr(F.col("l")).alias("t")).collect():
        assert r["t"] == repr(lists[r["i"]])


@pytest.mark.parametrize("s", [" \t\n x 　", "\x1c\x1dy\x85\xa0", " ", "  ", "a b", "​ z"])
def test_strip_equals_python(spark, s):
    df = spark.createDataFrame([(s,)], "s string")
    assert df.select(strip(F.col("s")).alias("t")).first()["t"] == s.strip()
