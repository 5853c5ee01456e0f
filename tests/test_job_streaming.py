"""End to end: the two halves of the batch job on a CSV catalogue, the CSV
export read back, and the reply stream."""

import json
import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fairgauge.plans.evaluate import results, streamed_results, write_requests, write_results
from fairgauge.operators.results import DISPLAY_A, DISPLAY_B
from fairgauge.plans import fixtures as X
from fairgauge.plans.strategies import STRATEGIES
from fairgauge.sources.replies import read_replies
from fairgauge.sources.requests import not_asked, open_keys
from fairgauge.streaming.replies import score_replies, start_scoring
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def job(spark):
    out = tempfile.mkdtemp(prefix="fairgauge-job-")
    urls = [r["url"] for r in X.load(spark, SF_SMALL, "pages").orderBy("page_id").limit(6).collect()]
    lines = ["Dataset Name,Website Link,data file"]
    lines += [f"D{i},{u},x" for i, u in enumerate(urls)]
    lines += [f"Mirror,{urls[0]}#again,", "Nowhere,http://missing.example.test/1,", "Empty,,"]
    cat = os.path.join(out, "catalog.csv")
    with open(cat, "w", encoding="utf-8") as f:
        f.write("\r\n".join(lines) + "\r\n")
    req_path = write_requests(spark, cat, f"{SF_SMALL}/pages.parquet", out, hot_rows=2, buckets=4)
    reqs = spark.read.parquet(req_path)
    # replies as chat-completion bodies, one multi-line and quoted
    replies = []
    for i, r in enumerate(reqs.select("request_id", "strategy", "row_id").orderBy("request_id").collect()):
        text = f'  Here:\n| D "{i}" | F-Score ({i % 18}/17) | A-Score (8/10) | I-Score (7/8) | R-Score (4/7) |\n'
        body = json.dumps({"choices": [{"message": {"content": text}}]})
        replies.append({"request_id": r["request_id"], "strategy": r["strategy"], "row_id": r["row_id"], "body": body})
    rdir = os.path.join(out, "replies_in")
    os.makedirs(rdir)
    with open(os.path.join(rdir, "part-0.json"), "w") as f:
        f.write("\n".join(json.dumps(x) for x in replies))
    res_path = write_results(spark, req_path, os.path.join(rdir, "part-0.json"), out)
    return out, reqs, spark.read.parquet(res_path), rdir, len(lines) - 1


def test_requests_cover_catalogue_times_strategies(job):
    _, reqs, _, _, n = job
    assert reqs.count() == n * 4
    assert reqs.select("request_id").distinct().count() == n * 4
    errors = {r["scrape_error"] for r in reqs.collect()}
    assert "no_page" in errors


def test_results_and_csv_round_trip(spark, job):
    out, reqs, res, _, n = job
    assert res.count() == n * 4
    assert res.where(F.col("parse_success")).count() == n * 4
    back = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(f"{out}/results_zero_shot_csv"))
    assert back.count() == n
    assert back.columns == list(DISPLAY_A.values()) and len(back.columns) == 13
    raw = back.first()["FAIR Raw Output"]
    assert raw.startswith("  Here:\n|") and raw.endswith("|\n")
    for s in STRATEGIES:
        if s["dialect"] == "B":
            shot = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{out}/results_{s['strategy']}_csv")
            assert shot.columns == list(DISPLAY_B.values()) and len(shot.columns) == 16
            assert shot.where(F.col("Scraped File Formats").startswith("[")).count() == n
            ordered = res.where(F.col("strategy") == s["strategy"]).orderBy("row_id").collect()
            assert [r["Dataset Name"] for r in shot.collect()] == [r["dataset_name"] for r in ordered]


def test_requests_are_never_overwritten(spark, job):
    out, *_ = job
    with pytest.raises(AnalysisException):
        write_requests(spark, os.path.join(out, "catalog.csv"), f"{SF_SMALL}/pages.parquet", out)


def test_reply_stream_equals_batch(spark, job):
    out, _, res, rdir, n = job
    q = start_scoring(spark, rdir, f"{out}/stream_out", f"{out}/stream_ckpt")
    q.awaitTermination(120)
    streamed = spark.read.parquet(f"{out}/stream_out")
    cols = ["request_id", "parse_success", "f_score", "a_score", "i_score", "r_score", "all_valid"]
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in res.select(*cols).collect())
    assert a == b and len(a) == n * 4


SCORES = "| D | F-Score (1/17) | A-Score (2/10) | I-Score (3/8) | R-Score (4/7) |"


def _reply_file(rdir, name, rows):
    with open(os.path.join(rdir, name), "w") as f:
        f.write("\n".join(json.dumps({"request_id": r["request_id"], "strategy": r["strategy"], "row_id": r["row_id"], "response": t}) for r, t in rows))


def test_a_better_reply_replaces_an_earlier_one(spark, job):
    out, reqs, _, _, n = job
    rdir, table, ckpt = f"{out}/late_in", f"{out}/late_out", f"{out}/late_ckpt"
    os.makedirs(rdir)
    rows = reqs.select("request_id", "strategy", "row_id").orderBy("request_id").collect()
    batches = [
        [(rows[0], "no table"), (rows[1], SCORES), (rows[2], ""), (rows[3], None), (rows[4], SCORES), (rows[4], "zz")],
        [(rows[0], SCORES), (rows[1], "no table"), (rows[2], "text"), (rows[3], ""), (rows[4], "aa")],
        [(rows[0], "no"), (rows[2], SCORES)],
    ]
    for k, batch in enumerate(batches):
        _reply_file(rdir, f"part-{k}.json", batch)
        start_scoring(spark, rdir, table, ckpt).awaitTermination(120)
        u = {r["request_id"]: r for r in streamed_results(spark, f"{out}/requests", table).collect()}
        assert len(u) == 4 * n
        for r in rows[:5]:
            seen = [t for b in batches[: k + 1] for x, t in b if x is r]
            best = min(seen, key=lambda t: (4, "") if t is None else (0 if t == SCORES else 2 if t else 3, t))
            assert u[r["request_id"]]["fair_raw_output"] == best
            assert u[r["request_id"]]["parse_success"] == (best == SCORES)
    # A reply that changes nothing leaves no row, so the table grows by improvements only.
    assert spark.read.parquet(table).where(F.col("fair_raw_output").isNotNull()).count() == 8


def test_streamed_results_equal_the_batch(spark, job):
    out, _, res, rdir, n = job
    start_scoring(spark, rdir, f"{out}/again_out", f"{out}/again_ckpt").awaitTermination(120)
    cols = [c for c in res.columns if c != "scraped_file_formats"]
    got = streamed_results(spark, f"{out}/requests", f"{out}/again_out").select(*cols)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, res.select(*cols).collect()), key=repr)


def test_a_second_run_asks_only_what_is_new(spark, job):
    out, reqs, _, _, n = job
    first = open(os.path.join(out, "catalog.csv"), encoding="utf-8", newline="").read()
    longer = os.path.join(out, "longer.csv")
    with open(longer, "w", encoding="utf-8", newline="") as f:
        f.write(first + '"Added\nlater",http://missing.example.test/2,\r\nBad,http://x,y,z\r\nLast,,\r\n')
    args = (f"{SF_SMALL}/pages.parquet", out)
    path = write_requests(spark, longer, *args, run="second")
    both = spark.read.parquet(path)
    new = both.where("run = 'second'")
    assert {r["dataset_name"] for r in new.collect()} == {"Added\nlater", "Last"} and new.count() == 8
    assert {r["row_id"] for r in new.collect()} == {n, n + 2}
    assert both.select("request_id").distinct().count() == both.count() == 4 * n + 8
    assert spark.read.text(f"{out}/request_lines/run=second").count() == 8
    bad = spark.read.parquet(f"{out}/catalog_bad/run=second").collect()
    assert [(r["row_id"], r["record"]) for r in bad] == [(n + 1, "Bad,http://x,y,z")]
    keys, buckets = open_keys(spark, f"{path}_keys")
    assert buckets == 4 and keys.count() == 4 * n + 8
    write_requests(spark, longer, *args, run="third")  # nothing is new
    assert open_keys(spark, f"{path}_keys")[0].count() == 4 * n + 8


def test_requests_stay_where_they_are_in_the_reply_join(spark, job):
    out, _, _, rdir, _ = job
    keys, buckets = open_keys(spark, f"{out}/requests_keys")
    replies = read_replies(spark, os.path.join(rdir, "part-0.json"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = results(keys, replies, buckets)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join, _, rest = plan.partition("SortMergeJoin")
    left = rest[: rest.index("SortAggregate")]
    assert "Exchange" not in join and "Exchange" not in left and "Bucketed: true" in left
    assert plan.count("Exchange hashpartitioning") == 1  # the replies, once


@pytest.mark.parametrize("most_words", [1 << 20, 1])
def test_not_asked(spark, most_words):
    asked = spark.range(0, 3000, 3).selectExpr("sha2(cast(id as string), 256) AS request_id")
    drawn = spark.range(2000).selectExpr("id", "sha2(cast(id as string), 256) AS request_id", "'prompt' AS user_content")
    got = [r["id"] for r in not_asked(drawn, asked, most_words).collect()]
    assert sorted(got) == [i for i in range(2000) if i % 3]
    assert not_asked(drawn, asked.limit(0)).count() == 2000


def test_score_replies_batch_input(spark):
    df = spark.createDataFrame(
        [("r1", "zero_shot", 1, "| D | F-Score (1/17) | A-Score (2/10) | I-Score (3/8) | R-Score (4/7)"),
         ("r2", "few_shot", 2, "| D | F-Score (1/17) | A-Score (2/10) | I-Score (3/8) | R-Score (4/7)")],
        "request_id string, strategy string, row_id long, response string")
    got = {r["request_id"]: r["parse_success"] for r in score_replies(df).collect()}
    assert got == {"r1": False, "r2": True}
