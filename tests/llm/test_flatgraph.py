from __future__ import annotations

import numpy as np
import pytest
from fairgauge.llm import flatgraph

SCHEMA = "vec_id long, embedding array<float>, label int, node long, vector string, shard int, links long, component_id string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2, 3, "y") for i, v in rows], SCHEMA)


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v)


def brute_force(rows, t=0.9):
    near = np.zeros((len(rows), len(rows)), bool)
    for d in {len(v) for _, v in rows if usable(v)}:  # vectors of different lengths don't link
        of = np.array([k for k, (_, v) in enumerate(rows) if usable(v) and len(v) == d])
        x = np.array([np.array(rows[k][1], np.float32).astype(float) for k in of])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near[np.ix_(of, of)] = x @ x.T >= t
    np.fill_diagonal(near, False)
    root = np.arange(len(rows))
    while True:
        low = np.array([min([root[i], *root[near[i]]]) for i in range(len(rows))])
        if (low == root).all():
            break
        root = low
    ids = [i for i, _ in rows]
    smallest = {r: min([ids[j] for j in np.flatnonzero(root == r) if ids[j] is not None], default=None) for r in set(root.tolist())}
    return sorted(((ids[i], int(near[i].sum()), smallest[root[i]]) for i in range(len(rows))), key=repr)


def rows_of(rng, groups=6, size=40):
    rows = []
    for g in range(groups):
        centre = rng.normal(size=8)
        rows += [(100 * g + k, (centre + rng.normal(scale=0.1 + 0.03 * g, size=8)).tolist()) for k in range(size)]
    same = rng.normal(size=8).tolist()
    rows += [(5000 + k, same) for k in range(60)] + [(6000, (np.array(same) * 3).tolist())]
    nan, inf = float("nan"), float("inf")
    rows += [(7000, None), (7001, []), (7002, [0.0] * 8), (7003, [nan] * 8), (7004, [inf] + [1.0] * 7), (7005, [None] + [1.0] * 7),
             (7006, same[:4]), (7007, [1e-30] * 8), (7008, [1e30] * 8), (7009, [-1.0] * 8), (None, same), (5000, same), (None, None)]
    return rows


@pytest.mark.parametrize("shard,block", [(1000, 8192), (40, 8192), (1000, 50)])
def test_links_and_components(spark, monkeypatch, shard, block):
    monkeypatch.setattr(flatgraph, "SHARD_NODES", shard)
    monkeypatch.setattr(flatgraph, "BLOCK_NODES", block)
    rows = rows_of(np.random.default_rng(7))
    got = flatgraph.near_duplicates(table(spark, rows)).collect()
    want = brute_force(rows)
    found = sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr)
    if shard == 1000 and block == 8192:
        assert found == want
    else:  # cut into shards or blocks: the recall may be less than 1
        assert sum(n for _, n, _ in found) >= 0.95 * sum(n for _, n, _ in want)
        assert all(a[1] <= b[1] for a, b in zip(found, want, strict=True))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_small_groups_count_as_much_as_large_groups_of_copies(spark, monkeypatch):
    """Pairs on the borders of shards beside a few nodes of very many copies."""
    monkeypatch.setattr(flatgraph, "SHARD_NODES", 4)
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(200)]
    rows += [(1000 + k, (np.array(v) + rng.normal(scale=0.35, size=8)).tolist()) for k, v in rows]
    big = rng.normal(size=8)
    rows += [(3000 + k, (big + 0.01 * (k % 2)).tolist()) for k in range(600)]
    monkeypatch.setattr(flatgraph, "SAMPLE_ROWS", 400)
    got = flatgraph.near_duplicates(table(spark, rows), overlap=1).collect()
    found = {r.vec_id: r for r in got}
    want = {i: (n, c) for i, n, c in brute_force(rows)}
    linked = [i for i, (n, _) in want.items() if n and i < 3000]
    assert len(linked) > 50 and np.mean([found[i].n_links / want[i][0] for i in linked]) >= 0.97
    # Who hangs together with others has links, and the other way round.
    size = {c: sum(r.component_id == c for r in got) for c in {r.component_id for r in got}}
    assert all((r.n_links > 0) == (size[r.component_id] > 1) for r in got)


@pytest.mark.parametrize("shard", [1000, 30])
def test_every_length_has_links_of_its_own(spark, monkeypatch, shard):
    """Two lengths of many vectors, one of few; those of the shorter begin like the longer."""
    monkeypatch.setattr(flatgraph, "SHARD_NODES", shard)
    rng = np.random.default_rng(11)
    rows = [(100 * g + k, (c + rng.normal(scale=0.2, size=8)).tolist()) for g in range(4) for c in [rng.normal(size=8)] for k in range(30)]
    rows += [(1000 + k, v[:5]) for k, v in rows]
    same = rng.normal(size=4).tolist()
    rows += [(5000 + k, same) for k in range(4)] + [(6000, [2.0]), (6001, [3.0]), (6002, [-1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in flatgraph.near_duplicates(table(spark, rows)).collect()}
    want = {i: (n, c) for i, n, c in brute_force(rows)}
    assert got[5000] == (3, 5000) and got[5003] == (3, 5000) and got[6001] == (1, 6000) and got[6002] == (0, 6002)
    assert set(got) == set(want)
    if shard == 1000:
        assert got == want
    else:
        assert sum(n for n, _ in got.values()) >= 0.95 * sum(n for n, _ in want.values())
        assert all(got[i][0] <= want[i][0] for i in want)


def test_nothing_usable_and_empty(spark):
    assert {(r.vec_id, r.n_links, r.component_id) for r in flatgraph.near_duplicates(table(spark, [(1, None), (2, [0.0])])).collect()} == {(1, 0, 1), (2, 0, 2)}
    assert flatgraph.near_duplicates(table(spark, [])).count() == 0


def test_pruned_neighbours_are_not_closer_to_a_kept_one():
    x = flatgraph._unit(np.random.default_rng(1).normal(size=(80, 8)))
    kept = flatgraph.robust_prune(x, 0, np.arange(80), 40).tolist()
    away = 1 - x @ x.T
    for j in set(range(1, 80)) - set(kept):
        assert any(away[0, p] <= away[0, j] and flatgraph.ALPHA * away[p, j] <= away[0, j] for p in kept)
