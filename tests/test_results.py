"""Result and derived tables (OUT-*, DER-1 … DER-3) against pandas brute force."""

import pandas as pd
import pytest

from fairgauge.operators import results as R
from fairgauge.plans.queries import unified_results
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def uni(spark):
    u = unified_results(spark, SF_SMALL)
    return u, u.toPandas()


def test_one_row_per_catalogue_row_and_strategy(uni):
    _, p = uni
    assert p.groupby(["row_id", "strategy"]).size().max() == 1
    assert p["strategy"].value_counts().nunique() == 1
    assert (p.loc[p.all_valid, ["f_valid", "a_valid", "i_valid", "r_valid"]].all(axis=None))


def test_component_scores(uni):
    u, p = uni
    long = R.component_scores(u).toPandas()
    assert len(long) == 4 * len(p)
    f = long[long.principle == "Findable"].set_index(["strategy", "row_id"])["score"]
    want = p.set_index(["strategy", "row_id"])["f_score"]
    pd.testing.assert_series_equal(f.sort_index(), want.sort_index(), check_names=False, check_dtype=False)


def test_strategy_summary(uni):
    u, p = uni
    s = R.strategy_summary(u).toPandas().set_index("strategy")
    for strategy, g in p.groupby("strategy"):
        assert s.loc[strategy, "n_rows"] == len(g)
        assert s.loc[strategy, "n_parsed"] == g.parse_success.sum()
        assert s.loc[strategy, "n_valid"] == g.all_valid.sum()
        v = g[g.all_valid]
        if len(v):
            assert s.loc[strategy, "mean_f"] == pytest.approx(round(v.f_score.mean(), 4))


def test_dataset_ranking(uni):
    u, p = uni
    r = R.dataset_ranking(u).toPandas()
    v = p[p.all_valid].copy()
    v["total"] = v.f_score + v.a_score + v.i_score + v.r_score
    v["rank"] = v.groupby("strategy")["total"].rank(method="min", ascending=False).astype(int)
    got = r.set_index(["strategy", "row_id"])["rank"].sort_index()
    want = v.set_index(["strategy", "row_id"])["rank"].sort_index()
    assert (got.values == want.values).all() and len(got) == len(want)


def test_result_layouts(uni):
    u, _ = uni
    a = R.result_a(u)
    b = R.result_b(u)
    assert a.columns[2:] == list(R.DISPLAY_A)
    assert b.columns[2:] == list(R.DISPLAY_B)
    assert a.count() + b.count() == u.count()


def test_ranking_reads_the_results_once(spark):
    """Histogram and ranked rows each computed the results anew."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [("s", k, f"D{k}", True, k % 18, 1, 1, 1) for k in range(50)]
    schema = "strategy string, row_id long, dataset_name string, all_valid boolean, f_score long, a_score long, i_score long, r_score long"
    df = spark.createDataFrame(rows, schema)
    assert len(R.dataset_ranking(df.mapInArrow(count, df.schema)).collect()) == 50
    assert seen.value == 50


def test_requests_are_built_once(spark):
    """Each side of JOIN-2 extracted the pages and built the prompts anew."""
    plan = unified_results(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "<title" not in plan and "html" not in plan
