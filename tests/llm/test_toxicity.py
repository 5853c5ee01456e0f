from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from fairgauge.llm import toxicity
from llm_tables import SCHEMA, awkward_rows, documents, prose

LABELS = "doc_id long, quality int, toxic int, score string"


def test_features():
    names = toxicity.FEATURES
    lexicon = toxicity._hashes(["grumble"])
    args = (lexicon, toxicity._hashes(toxicity.INSULTS), toxicity._hashes(toxicity.SECOND_PERSON))
    texts = [b"", b"You are a grumble, IDIOT! a b c d e f g", b"gr0mb1e is fine? gruMble5", "ça va, 1d10t".encode(), b"a" * 9000]
    f = toxicity.features(texts, *args)
    assert not f[0].any()
    one = dict(zip(names, f[1], strict=True))
    assert one["lexicon"] == pytest.approx(1 / 12) and one["insults"] == pytest.approx(np.log(2))
    assert one["near_you"] == pytest.approx(np.log(3)) and one["shouted"] == pytest.approx(1 / 12)
    assert one["exclamations"] == pytest.approx(1 / 12) and one["capitals"] == pytest.approx(6 / len(texts[1]))
    assert dict(zip(names, f[3], strict=True))["undisguised"] == pytest.approx(np.log(2))
    alone = np.vstack([toxicity.features([t], *args) for t in texts])
    assert np.allclose(f, alone)


def labelled(rnd, n=400):
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = prose(rnd, rnd.randrange(5, 60)).split()
        if bad:
            for w in ("zorgish", "zorgle", "frabby")[: 1 + i % 3]:
                words.insert(rnd.randrange(len(words)), w)
        rows.append((i, " ".join(words), "a"))
        labels.append((i, 1, int(bad), "x"))
    return rows, labels


def test_learned_lexicon_on_held_out_rows(spark):
    rows, labels = labelled(random.Random(6))
    extra = [r if r[0] is None else (r[0] + 10_000, *r[1:]) for r in awkward_rows()]
    got = toxicity.score_toxicity(
        documents(spark, rows + extra), spark.createDataFrame([*labels, (None, 1, 1, ""), (5, 1, None, "")], LABELS)
    ).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 10_000]
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in held) >= 0.95 * len(held)
    scores = {r.doc_id: r.score for r in got}
    assert scores[10_004] == scores[10_005]  # the text alone decides


def plain_margin(trees, row):
    """Weighted sum of the leaves that ``row`` falls into, node by node."""
    total = 0.0
    for weight, tree in zip(trees.treeWeights, trees.trees, strict=True):
        node = tree._call_java("rootNode")
        while node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            node = node.leftChild() if row[split.featureIndex()] <= split.threshold() else node.rightChild()
        total += weight * node.prediction()
    return total


def plain_isotonic(margins, labels):
    """Knots of the isotonic fit by its max-min formula; equal margins count as one."""
    x = np.unique(margins)
    sums = np.array([labels[margins == v].sum() for v in x])
    sizes = np.array([(margins == v).sum() for v in x])
    mean = lambda a, b: sums[a : b + 1].sum() / sizes[a : b + 1].sum()
    fitted = [max(min(mean(a, b) for b in range(i, len(x))) for a in range(i + 1)) for i in range(len(x))]
    return x, np.array(fitted)


def test_scores_equal_a_plain_evaluation(spark, monkeypatch):
    """Every score from the fitted trees walked by hand and an isotonic fit by definition."""
    seen = []
    margin, learn = toxicity._margin, toxicity.learn_lexicon
    monkeypatch.setattr(toxicity, "_margin", lambda trees, rows: (seen.append((trees, rows)), margin(trees, rows))[1])
    lexicons = []
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda rows: (lexicons.append(learn(rows)), lexicons[-1])[1])
    rnd = random.Random(9)
    rows, labels = labelled(rnd)
    labels = [(i, q, 1 - t if rnd.random() < 0.1 else t, x) for i, q, t, x in labels]  # so that pools form
    got = toxicity.score_toxicity(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    trees, calibration = seen[0]
    at = calibration.select("label", *toxicity.FEATURES).collect()
    knots = plain_isotonic(np.array([plain_margin(trees, r[1:]) for r in at]), np.array([r.label for r in at]))
    assert 1 < len(np.unique(knots[1])) < len(knots[0])
    args = lexicons[0], toxicity._hashes(toxicity.INSULTS), toxicity._hashes(toxicity.SECOND_PERSON)
    texts = {i: text for i, text, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        m = plain_margin(trees, toxicity.features([texts[r.doc_id].encode()], *args)[0].tolist())
        want = 0.99 * np.interp(m, *knots) + 0.01 / (1 + np.exp(-2 * m))
        assert r.score == pytest.approx(want, abs=1e-9)


def test_held_out_labels_of_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.score_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    rows = got.where("held_out").join(labels, "doc_id").collect()
    bad, good = ([r.score for r in rows if r.toxic == x] for x in (1, 0))
    assert np.mean([[(b > g) + 0.5 * (b == g) for g in good] for b in bad]) >= 0.8
    assert sum(g >= 0.5 for g in good) <= 0.02 * len(good)


def test_one_class_no_labels_empty(spark):
    docs = documents(spark, awkward_rows())
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.score_toxicity(docs, none).collect()} == {0.0}
    bad = spark.createDataFrame([(i, 1, 1, "") for i in range(1, 15)], LABELS)
    assert {r.score for r in toxicity.score_toxicity(docs, bad).collect()} == {1.0}
    rows, labels = labelled(random.Random(2), 60)
    assert toxicity.score_toxicity(spark.createDataFrame([], SCHEMA), spark.createDataFrame(labels, LABELS)).count() == 0
