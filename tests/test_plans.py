"""Plan checks: only the HTML that the catalogue needs is read
into the extraction, none of it is shuffled after, and no partition count is fixed."""

import pytest

from fairgauge.plans import queries as Q
from fairgauge.plans.evaluate import REQUEST_COLUMNS
from tests.conftest import SF_SMALL


def _nodes(plan):
    out = [plan]
    kids = plan.children()
    for i in range(kids.size()):
        out += _nodes(kids.apply(i))
    return out


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    return [n for n in _nodes(plan) if n.nodeName() == "Exchange"]


def _names(node):
    attrs = node.output()
    return {attrs.apply(i).name() for i in range(attrs.size())}


@pytest.fixture(scope="module")
def request_exchanges(spark):
    return _exchanges(Q.request_table(spark, SF_SMALL).select(*REQUEST_COLUMNS))


def test_html_is_shuffled_for_the_join_with_the_needed_pages_at_most(request_exchanges):
    assert request_exchanges
    for ex in request_exchanges:
        if "html" in _names(ex):  # to the semi-join's own keys, when those can't be broadcast
            assert "page_id" in ex.outputPartitioning().toString()


def test_extraction_reads_needed_pages_only(spark):
    plan = Q.joined_catalog(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    semi = [k for k, x in enumerate(lines) if "Join LeftSemi" in x]
    extraction = [k for k, x in enumerate(lines) if "<title" in x and "regexp_extract" in x]
    assert semi and extraction
    assert min(extraction) < max(semi)  # the extracting projection stands above the semi-join


def test_no_fixed_partition_count(request_exchanges):
    assert all(ex.shuffleOrigin().toString() == "ENSURE_REQUIREMENTS" for ex in request_exchanges)


def test_ranking_filter_is_not_pushed_below_the_parsing(spark):
    from fairgauge.operators.results import dataset_ranking

    plan = dataset_ranking(Q.unified_results(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if "Filter" in x and "F-Score" in x and "regexp_extract" in x]


def test_ranking_window_runs_on_the_broadcast_histogram(spark):
    from fairgauge.operators.results import dataset_ranking

    plan = dataset_ranking(Q.unified_results(spark, SF_SMALL))._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    broadcasts = [n for n in _nodes(plan) if n.nodeName() == "BroadcastExchange"]
    windows_under_broadcast = {id(w) for b in broadcasts for w in _nodes(b) if w.nodeName() == "Window"}
    windows = [n for n in _nodes(plan) if n.nodeName() == "Window"]
    assert windows and len(windows_under_broadcast) == len(windows)
