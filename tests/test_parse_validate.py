"""Reply parsing (PA-1 … PA-5) and validation (VA-1, VA-2).

The brute-force oracle is Python's own ``re`` with the scoring scripts'
patterns, run on the same replies.
"""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from fairgauge.operators.joins import dedupe_replies
from fairgauge.operators.parse import lenient, multi_row_reply, strict, with_parsed
from fairgauge.operators.validate import valid_a, valid_b

# The scoring scripts' reply patterns (strict zero-shot form,
# lenient one-/few-shot form), used here only as the test oracle.
PY_STRICT = (
    r'\|\s*(.*?)\s*\|'
    r'\s*F-Score \((\d+)/17\)\s*\|'
    r'\s*A-Score \((\d+)/10\)\s*\|'
    r'\s*I-Score \((\d+)/8\)\s*\|'
    r'\s*R-Score \((\d+)/7\)\s*\|'
)
PY_LENIENT = r'\|\s*(.*?)\s*\|\s*F-Score \((\d+)/17\).*A-Score \((\d+)/10\).*I-Score \((\d+)/8\).*R-Score \((\d+)/7\)'

ROW = "| D1 | F-Score (9/17) | A-Score (8/10) | I-Score (7/8) | R-Score (4/7) |"
HDR = "| Dataset Name | F-Score (X/17) | A-Score (X/10) | I-Score (X/8) | R-Score (X/7) |\n|---|---|---|---|---|\n"
REPLIES = [
    ROW,
    ROW[:-2],
    HDR + "| D1 | 9 | 8 | 7 | 4 |",
    HDR + ROW,
    "| D1 | F-Score (1/17) | A-Score (2/10) | I-Score (3/8) | R-Score (4/7) |\n"
    "| D2 | F-Score (5/17) | A-Score (6/10) | I-Score (7/8) | R-Score (1/7) |",
    "|  | F-Score (9/17) | A-Score (8/10) | I-Score (7/8) | R-Score (4/7) |",
    ROW.replace("(9/17)", "(99999999999999/17)"),
    ROW.replace("(9/17)", "(-1/17)"),
    ROW.replace("F-Score (9/17)", "**F-Score (9/17)**"),
    "no table",
    "Sure!\n| Name |\tF-Score (3/17)|A-Score (2/10) |\n I-Score (1/8) | R-Score (0/7) |\nThanks",
    "| a | F-Score (1/17) | A-Score (2/10) | junk | I-Score (3/8) | R-Score (4/7) |",
    "",
    ROW.replace("9/17", "\u0661\u0662/17").replace("8/10", "\uff18/10").replace("4/7", "\U0001d7d4/7"),
    ROW.replace("D1", "\u0663").replace("9/17", "1\u0967/17"),
    ROW.replace("9/17", "9/\u0661\u0667"),
    ROW.replace("9/17", "\u00b9/17"),
]


def py_parse(pattern, reply):
    if reply is None:
        return None
    m = re.search(pattern, reply, flags=re.DOTALL)
    if not m:
        return None
    return (m.group(1).strip(), int(m.group(2)), int(m.group(3)), int(m.group(4)), int(m.group(5)))


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(REPLIES + [None])], "i int, reply string")
    fields = ("parse_ok", "parsed_dataset_name", "f_score", "a_score", "i_score", "r_score")
    both = df.select("i", "reply", strict(F.col("reply")).alias("a"), lenient(F.col("reply")).alias("b"),
                     multi_row_reply(F.col("reply")).alias("multi"))
    rows = both.select("i", "reply", "multi", *[F.col(f"{t}.{k}").alias(f"{t}_{k}") for t in "ab" for k in fields]).collect()
    return {r["i"]: r for r in rows}


@pytest.mark.parametrize("i", range(len(REPLIES) + 1))
@pytest.mark.parametrize("tag,pattern", [("a", PY_STRICT), ("b", PY_LENIENT)])
def test_parse_equals_python(parsed, i, tag, pattern):
    r = parsed[i]
    want = py_parse(pattern, r["reply"])
    got = tuple(r[f"{tag}_{k}"] for k in ("parsed_dataset_name", "f_score", "a_score", "i_score", "r_score"))
    if want is None:
        assert r[f"{tag}_parse_ok"] is False
        assert got == (None,) * 5
    else:
        assert r[f"{tag}_parse_ok"] is True
        assert got == want


def test_documented_reply_semantics(parsed):
    # header alone does not parse; header then row gives a multi-line name
    assert parsed[2]["a_parse_ok"] is False and parsed[2]["b_parse_ok"] is False
    assert "\n" in parsed[3]["a_parsed_dataset_name"]
    # two rows: strict takes the first, lenient mixes F of the first with A/I/R of the last
    assert (parsed[4]["a_f_score"], parsed[4]["a_a_score"]) == (1, 2)
    assert (parsed[4]["b_f_score"], parsed[4]["b_a_score"], parsed[4]["b_r_score"]) == (1, 6, 1)
    assert parsed[4]["multi"] is True and parsed[0]["multi"] is False
    # no closing pipe: only the lenient form parses
    assert parsed[1]["a_parse_ok"] is False and parsed[1]["b_parse_ok"] is True
    # empty first cell parses with an empty name
    assert parsed[5]["a_parsed_dataset_name"] == ""
    # NULL reply: not parsed (the scripts would abort)
    assert parsed[len(REPLIES)]["a_parse_ok"] is False


def test_random_replies_equal_python(spark):
    rnd = random.Random(11)
    parts = ["| D |", "|", " ", "\n", "   ", "name", "F-Score (3/17)", "| F-Score (4/17)", "A-Score (5/10)", "| A-Score (6/10) |",
             "I-Score (7/8)", "| I-Score (1/8)", "R-Score (2/7)", "| R-Score (0/7) |", "F-Score (x/17)", "A-Score (12", "\u00a0", "|\t",
             "| E | F-Score (9/17) | A-Score (8/10) | I-Score (7/8) | R-Score (4/7) |"]
    replies = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 16))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(replies)), "i int, reply string")
    rows = df.select("i", strict(F.col("reply")).alias("a"), lenient(F.col("reply")).alias("b")).collect()
    found = 0
    for r in rows:
        for got, pattern in ((r["a"], PY_STRICT), (r["b"], PY_LENIENT)):
            want = py_parse(pattern, replies[r["i"]])
            found += want is not None
            assert (got["parse_ok"], tuple(got)[1:]) == (want is not None, want or (None,) * 5), replies[r["i"]]
    assert found > 200


def test_parsing_takes_linear_time(spark):
    header = "| Dataset Name | F-Score (X/17) | A-Score (X/10) | I-Score (X/8) | R-Score (X/7) |\n"
    cells = "| F-Score (1/17) | A-Score (2/10) | I-Score (3/8) "
    cases = [header + cells * 40, "|" + " " * 800 + "F-Score (1/17)", header + cells * 4000, "| F-Score (1/17)" + " " * 200_000 + "|", "|" * 200_000]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, reply string").repartition(1)
    both = df.select(strict(F.col("reply")).alias("a"), lenient(F.col("reply")).alias("b"))
    both.collect()
    begun = time.perf_counter()
    assert not any(r["a"]["parse_ok"] or r["b"]["parse_ok"] for r in both.collect())
    assert time.perf_counter() - begun < 6


def test_rows_of_unknown_dialect_stay_unparsed(spark):
    df = spark.createDataFrame([(ROW, "A"), (ROW, None), (ROW, "C")], "response string, dialect string")
    assert [r["parse_ok"] for r in with_parsed(df).collect()] == [True, None, None]


def test_the_reply_that_says_most_is_kept(spark):
    rows = [("a", ""), ("a", ROW), ("a", None), ("b", None), ("c", "zz"), ("c", "aa"), ("c", " "), ("d", ""), ("d", None)]
    got = {r["request_id"]: (r["response"], r["reply_count"]) for r in dedupe_replies(spark.createDataFrame(rows, "request_id string, response string")).collect()}
    assert got == {"a": (ROW, 3), "b": (None, 1), "c": ("aa", 3), "d": ("", 2)}


BARE = "| Dataset Name | F-Score (X/17) | A-Score (X/10) | I-Score (X/8) | R-Score (X/7) |\n| D | 9 | 8 | 7 | 4 |"
LOOSE = "| D | F-Score (1/17) | A-Score (2/10)\n and then I-Score (3/8) | R-Score (4/7) |"


def test_a_reply_with_scores_goes_before_one_without(spark):
    rows = [("a", BARE), ("a", ROW), ("b", ROW), ("b", LOOSE), ("c", LOOSE), ("c", BARE), ("c", None), ("d", BARE), ("d", "")]
    df = spark.createDataFrame(rows, "request_id string, response string")
    got = {r["request_id"]: r for r in dedupe_replies(df).collect()}
    assert {k: r["response"] for k, r in got.items()} == {"a": ROW, "b": ROW, "c": LOOSE, "d": BARE}
    assert {k: (r["strict"]["parse_ok"], r["lenient"]["parse_ok"]) for k, r in got.items()} == {
        "a": (True, True), "b": (True, True), "c": (False, True), "d": (False, False)}


VALIDATION = [
    # f, a, i, r, parse_ok, valid_a, flags_b, all_valid
    (17, 10, 8, 7, True, True, (True, True, True, True), True),
    (18, 10, 8, 7, True, False, (False, True, True, True), False),
    (0, 0, 0, 0, True, True, (True, True, True, True), True),
    (None, None, None, None, False, False, (False, False, False, False), False),
    (None, 3, 3, 3, True, False, (False, True, True, True), False),
]


@pytest.mark.parametrize("case", VALIDATION)
def test_validation(spark, case):
    f, a, i, r, ok, va, flags, allv = case
    df = spark.createDataFrame([(f, a, i, r, ok)], "f_score bigint, a_score bigint, i_score bigint, r_score bigint, parse_ok boolean")
    row = valid_b(valid_a(df)).first()
    assert row["valid_scores"] is va
    assert (row["f_valid"], row["a_valid"], row["i_valid"], row["r_valid"]) == flags
    assert row["all_valid"] is allv
