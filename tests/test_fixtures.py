"""Non-vacuity and invariants: the fixtures give
every extraction and parsing branch rows, so the oracle comparison is not a
comparison of defaults."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from fairgauge.operators.parse import lenient, strict
from fairgauge.plans import fixtures as X
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def ext(spark):
    return E.queries()["scrape_record_a"](spark, SF_MID).toPandas()


def test_every_extraction_branch_has_rows(ext):
    errors = ext.scrape_error.value_counts()
    for code in ("no_page", "empty_title", "nested_title", "meta_without_content"):
        assert errors.get(code, 0) > 0, code
    ok = ext[ext.scrape_ok]
    assert (ok.title == "Not found").any() and (ok.title != "Not found").any()
    assert (ok.description == "Not found").any() and ok.description.str.startswith("About & around").any()
    assert (ok.download_links == "None detected").any() and ok.download_links.str.contains(".CSV?x=1&y=2", regex=False).any()
    assert ok.file_formats.str.contains("CSV").any() and ok.file_formats.str.contains("pdf").any()
    assert ok.license_info.str.contains("CC-BY").any() and ok.license_info.str.contains("public domain").any()
    assert (ok.license_info == "Not detected").any()


def test_every_reply_shape_and_parse_outcome(spark):
    replies = X.turn_replies(X.load(spark, SF_MID, "conversations"))
    both = replies.select("response", strict(F.col("response")).alias("a"), lenient(F.col("response")).alias("b"))
    fields = ("parse_ok", "a_score", "r_score")
    p = both.select("response", *[F.col(f"{t}.{k}").alias(f"{t}_{k}") for t in "ab" for k in fields]).toPandas()
    assert p.response.isna().any() and (p.response == "").any()
    assert p.a_parse_ok.any() and (~p.a_parse_ok).any()
    assert (p.b_parse_ok & ~p.a_parse_ok).any()          # no closing pipe
    assert ((p.a_a_score > 10) | (p.a_r_score > 7)).any()  # out of range kept
    # strict parse implies lenient parse
    assert not (p.a_parse_ok & ~p.b_parse_ok).any()


def test_result_invariants(spark):
    u = E.queries()["result_unified"](spark, SF_MID).toPandas()
    cat = E.queries()["catalog_join"](spark, SF_MID).count()
    assert len(u) == cat * 4
    v = u[u.all_valid]
    assert v.f_score.between(0, 17).all() and v.a_score.between(0, 10).all()
    assert v.i_score.between(0, 8).all() and v.r_score.between(0, 7).all()
    assert (u.valid_scores == u.all_valid).all()
    assert u.multi_row_reply.any()
