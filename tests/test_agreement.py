"""The strategies' agreement (DER-4 … DER-6) against definitions written out over all pairs."""

import math
from itertools import combinations

import pytest

from fairgauge.operators import agreement as A

SCHEMA = "strategy string, row_id long, all_valid boolean, f_score int, a_score int, i_score int, r_score int"


def results(spark):
    """Three strategies over 60 datasets: one agrees mostly, one is nearly reversed; the
    third gives one score only for Reusable; some rows are invalid or absent."""
    rows = []
    for k in range(60):
        f, a, i, r = k * 7 % 18, k * 5 % 11, k * 3 % 9, k % 8
        rows.append(("one", k, k % 13 != 0, f, a, i, r))
        rows.append(("two", k, k % 17 != 0, min(17, f + k % 3), 10 - a, i, (r + k % 2) % 8))
        if k % 5:
            rows.append(("three", k, True, 17 - f, k * k % 11, 4, 3))
    rows.append(("one", 99, None, None, 1, 1, 1))
    return rows, spark.createDataFrame(rows, SCHEMA)


def both(rows):
    """(strategy_a, strategy_b, measure) -> scores of datasets that are valid under both."""
    valid = {(s, k): {"Total": sum(x), **dict(zip(["Findable", "Accessible", "Interoperable", "Reusable"], x, strict=True))} for s, k, ok, *x in rows if ok}
    out = {}
    for a, b in combinations(["one", "three", "two"], 2):
        for m in A.MEASURES:
            out[a, b, m] = [(valid[a, k][m], valid[b, k][m]) for k in range(60) if (a, k) in valid and (b, k) in valid]
    return out


def kappa(scores, weight):
    n = len(scores)
    seen = sum(weight(x - y) for x, y in scores) / n
    chance = sum(weight(x - y) for x, _ in scores for _, y in scores) / n**2
    return None if chance == 0 else 1 - seen / chance


def tau_b(scores):
    c = d = ua = ub = 0
    for (x, y), (v, w) in combinations(scores, 2):
        c += (x - v) * (y - w) > 0
        d += (x - v) * (y - w) < 0
        ua += x != v
        ub += y != w
    return c, d, (c - d) / math.sqrt(ua * ub) if ua and ub else None


@pytest.fixture(scope="module")
def made(spark):
    rows, df = results(spark)
    return both(rows), A.score_pairs(df).cache()


def close(got, want):
    return got is None if want is None else got == pytest.approx(want, abs=1e-6)


def test_contingency_holds_each_dataset_once(made):
    want, pairs = made
    got = {}
    for r in pairs.collect():
        got.setdefault((r.strategy_a, r.strategy_b, r.measure), []).extend([(r.score_a, r.score_b)] * r.n)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_kappas_follow_their_definition(made):
    want, pairs = made
    got = A.agreement(pairs).collect()
    assert len(got) == len(want)
    for r in got:
        scores = want[r.strategy_a, r.strategy_b, r.measure]
        assert r.n == len(scores)
        assert close(r.equal_share, sum(x == y for x, y in scores) / r.n)
        assert close(r.mean_difference, sum(x - y for x, y in scores) / r.n)
        assert close(r.kappa_linear, kappa(scores, abs))
        assert close(r.kappa_quadratic, kappa(scores, lambda d: d * d))


def test_kendalls_tau_follows_its_definition(made):
    want, pairs = made
    got = A.rank_correlation(pairs).collect()
    assert len(got) == len(want)
    for r in got:
        c, d, tau = tau_b(want[r.strategy_a, r.strategy_b, r.measure])
        assert (r.concordant, r.discordant) == (c, d) and close(r.tau_b, tau)
    assert any(r.tau_b is None for r in got) and any(r.tau_b is not None and r.tau_b < 0 for r in got)


def test_one_score_everywhere_and_nothing_at_all(spark):
    same = spark.createDataFrame([(s, k, True, 1, 1, 1, 1) for s in ("x", "y") for k in range(3)], SCHEMA)
    pairs = A.score_pairs(same)
    assert {(r.n, r.equal_share, r.kappa_linear, r.kappa_quadratic) for r in A.agreement(pairs).collect()} == {(3, 1.0, None, None)}
    assert {(r.concordant, r.discordant, r.tau_b) for r in A.rank_correlation(pairs).collect()} == {(0.0, 0.0, None)}
    nothing = A.score_pairs(same.limit(0))
    assert A.agreement(nothing).count() == A.rank_correlation(nothing).count() == 0


@pytest.mark.parametrize("statistic", [A.agreement, A.rank_correlation])
def test_results_are_read_for_the_contingency_alone(spark, statistic):
    """Each of a statistic's three or four reads of the contingency built it anew."""
    plan = statistic(A.score_pairs(results(spark)[1]))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
