from __future__ import annotations

import random

import numpy as np
import pytest
from fairgauge.llm import mixing
from llm_tables import SCHEMA, awkward_rows, documents, prose
from pyspark.sql import functions as F


def fill(sizes, weights, total, cap):
    """Targets by handing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full: set = set()
    while True:
        left = total * sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        level = left / open_weight if open_weight else 0
        new = {s for s in names if s not in full and level * weight[s] > cap * sizes[s] + 1e-9}
        if not new:
            return {s: cap * sizes[s] if s in full else level * weight[s] for s in names}
        full |= new


def sized_rows(seed=1):
    rnd = random.Random(seed)
    rows = [(i, prose(rnd, rnd.randrange(1, 60)), rnd.choice(["a", "b", "c", "é", "z", None])) for i in range(300)]
    return rows + [(1000 + i, prose(rnd, 30), "hot") for i in range(200)] + awkward_rows()


def test_targets_and_taken(spark):
    rows = sized_rows()
    got = mixing.mix_plan(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, of = {}, {}
    words = [len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", t or "")]) for _, t, _ in rows]
    for (i, t, s), n in zip(rows, words, strict=True):
        sizes[s] = sizes.get(s, 0) + n
        of.setdefault((i, n), []).append(s)
    want = fill(sizes, mixing.WEIGHTS, 1.5, 2.0)
    taken = {}
    by_target = {round(t, 6): s for s, t in want.items() if sizes[s]}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        if r.size:
            s = by_target[round(r.target, 6)]
            assert s in of[r.doc_id, r.size] and r.source_size == sizes[s]
            taken[s] = taken.get(s, 0) + r.taken
        assert (r.position is None) == (r.taken == 0)
    assert all(abs(taken[s] - want[s]) <= 1 for s in taken)
    positions = [r.position for r in got if r.position is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    assert got == mixing.mix_plan(documents(spark, rows).repartition(7)).collect()


@pytest.mark.parametrize("schedule", mixing.SCHEDULES)
def test_positions_invert_the_demand(spark, schedule):
    times = np.linspace(0, 1, 4001)
    rate = np.interp(times, [t for t, _ in schedule.knots], [r for _, r in schedule.knots])
    area = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2 * np.diff(times))])
    shares = [0.0, 0.01, 0.2, 0.5, 0.77, 1.0]
    got = spark.createDataFrame([(s,) for s in shares], "share double").select(schedule.time_of(F.col("share")).alias("t")).collect()
    for s, r in zip(shares, got, strict=True):
        assert abs(np.interp(r.t, times, area) / area[-1] - s) < 1e-6


def test_mix_repeats_whole_documents(spark):
    rows = [(i, f"text {i} of one size", "s" if i % 10 else "t") for i in range(400)]
    docs = documents(spark, rows)
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    count = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert set(count.values()) <= {1, 2}
    sizes = {"s": 360 * 5, "t": 40 * 5}
    want = fill(sizes, mixing.WEIGHTS, 1.5, 2.0)
    for s in sizes:
        assert abs(5 * sum(n for i, n in count.items() if ("s" if i % 10 else "t") == s) - want[s]) <= 5


def test_no_words_and_empty(spark):
    rows = mixing.mix_plan(documents(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert {(r.doc_id, r.size, r.target, r.taken) for r in rows} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_plan(empty).count() == 0
    assert mixing.mix_documents(empty).count() == 0
