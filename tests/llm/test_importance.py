from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from fairgauge.llm import importance
from fairgauge.llm.words import words_of
from llm_tables import SCHEMA, awkward_rows, documents, prose

LABELS = "doc_id long, quality int, toxic int, id string"


def corpus(rnd, n=160):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = " ".join([prose(rnd, 1)] * 30) if bad and i % 8 else prose(rnd, 30).upper().replace(" ", "!! ") if bad else prose(rnd, 40)
        rows.append((i, text, "a"))
        labels.append((i, int(not bad), 0, "x"))
    return rows, labels


def test_weights_and_top_k_against_brute_force(spark):
    rows, labels = corpus(random.Random(1))
    rows = [r if r[0] is None else (r[0] + 10_000, *r[1:]) for r in awkward_rows()] + rows
    docs, rated = documents(spark, rows), spark.createDataFrame(labels[: len(labels) // 2] + [(None, 1, 0, ""), (3, None, 0, "")], LABELS)
    got = importance.classify(docs, rated).collect()
    assert len(got) == len(rows)

    sample = importance.labelled_sample(rated, "doc_id", importance.SAMPLE_ROWS, importance.SEED).collect()
    grams = [Counter(importance.features(words_of([(t or "").encode()]))[0].tolist()) for _, t, _ in rows]
    good = {r.id for r in sample if not r.for_cut}
    assert good and good <= {i for i, q, _, _ in labels if q == 1}
    raw, target = Counter(), Counter()
    for (i, _, _), g in zip(rows, grams, strict=True):
        raw += g
        target += g if i in good else Counter()
    k = importance.BUCKETS
    sums = {m: [sum(v for b, v in c.items() if b // k == m) for c in (raw, target)] for m in (0, 1)}
    prior = [p * k for p in importance.PRIOR]

    def weight(g):
        return sum(
            n * math.log((target[b] * sums[b // k][0] / raw[b] + prior[b // k]) / (sums[b // k][1] + prior[b // k])) for b, n in g.items()
        )

    want = sorted((-1 if i is None else i, round(weight(g), 5)) for (i, _, _), g in zip(rows, grams, strict=True))
    assert sorted((-1 if r.doc_id is None else r.doc_id, round(r.log_weight, 5)) for r in got) == want
    assert min(r.key for r in got if r.kept) > max(r.key for r in got if not r.kept)
    known = {i: q for i, q, _, _ in labels}
    judged = [r.kept == bool(known[r.doc_id]) for r in got if r.doc_id in known and r.doc_id >= len(labels) // 2]
    assert sum(judged) >= 0.95 * len(judged)  # the half without labels

    assert all(r.kept for r in got if r.doc_id in (None, 10_001, 10_005, 10_013, 10_014))
    out = importance.classify(docs, rated, rows=True)
    assert out.columns == docs.columns
    assert sorted(repr((r.doc_id, r.text)) for r in out.collect()) == sorted(
        repr((i, t)) for i, t, _ in rows if i in {r.doc_id for r in got if r.kept}
    )


def test_held_out_labels_of_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = importance.classify(spark.read.parquet(f"{sf}/documents.parquet"), labels.where("doc_id % 2 = 0"))
    rows = got.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) >= 0.97 * len(rows)


def test_kth_largest(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-3, 6, 500), np.full(40, 2.5)])
    keys = spark.createDataFrame([(float(v),) for v in values], "key double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 250, 300, len(values)):
        assert importance.kth_largest(keys, k, ranges=8) == ordered[k - 1]
    assert importance.kth_largest(keys, 0) == math.inf


def test_best_cut():
    assert importance.best_cut(np.array([5.0, 9.0]), np.array([-3.0, 1.0])) == 3.0
    assert importance.best_cut(np.array([1.0]), np.array([])) == -math.inf
    cut = importance.best_cut(np.array([0.0, 4.0, 5.0, 6.0]), np.array([-5.0, 1.0, 2.0]))
    assert 2 < cut < 4


def test_without_labels_and_empty(spark):
    rows = awkward_rows()
    got = importance.classify(documents(spark, rows), spark.createDataFrame([], LABELS)).collect()
    assert len(got) == len(rows) and all(r.kept and r.log_weight == 0 for r in got)
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0, "")], LABELS)
    assert importance.classify(empty, labels).count() == 0
    assert importance.classify(empty, labels, rows=True).count() == 0
