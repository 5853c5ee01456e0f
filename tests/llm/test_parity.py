from __future__ import annotations

import random
import re
from fractions import Fraction

import numpy as np
import pytest
from fairgauge.llm import parity
from fairgauge.llm.components import components
from llm_tables import SCHEMA, awkward_rows, documents, prose


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def components_by_hand(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def brute_force(rows, n, t):
    sets = [shingles(text, n) for _, text, _ in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and len(sets[i] & sets[j]) * t.denominator >= len(sets[i] | sets[j]) * t.numerator
    ]
    root = components_by_hand(len(rows), links)
    out = []
    for i, (doc_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def check(spark, rows, n, t):
    got = parity.group_similar(documents(spark, rows), words=n, threshold=t).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_force(rows, n, t)


def family(rnd, first, size, words, most_edits):
    """Texts that differ from one another in up to twice ``most_edits`` words."""
    base = prose(rnd, words).split()
    out = []
    for k in range(size):
        text = list(base)
        for _ in range(rnd.randrange(most_edits + 1)):
            text[rnd.randrange(words)] = prose(rnd, 1)
        out.append((first + k, " ".join(text), "a"))
    return out


def test_awkward_rows(spark):
    check(spark, awkward_rows(), 4, Fraction(85, 100))


@pytest.mark.parametrize("n,t", [(4, Fraction(85, 100)), (5, Fraction(4, 5))])
def test_families_with_hot_keys(spark, monkeypatch, n, t):
    monkeypatch.setattr(parity, "SMALL_KEY", 3)
    monkeypatch.setattr(parity, "BLOCK", 8)  # several blocks for each hot key
    rnd = random.Random(n)
    rows = []
    for words, edits in ((40, 1), (120, 5), (300, 9), (8, 1), (5, 1)):
        rows += family(rnd, 1000 * len(rows), 40, words, edits)
    rnd.shuffle(rows)
    check(spark, rows, n, t)


def test_pigeonhole_finds_every_similar_pair():
    rng, t = np.random.default_rng(1), Fraction(85, 100)
    bands = parity.Bands(t)
    for size in (1, 2, 5, 6, 7, 12, 20, 33, 100, 400):
        for _ in range(40):
            a = rng.integers(0, 2**64, size, dtype=np.uint64)
            drop = rng.integers(0, max(1, int(size * 0.17)) + 1)
            b = np.concatenate([a[drop:], rng.integers(0, 2**64, rng.integers(0, int(size * 0.17) + 1), dtype=np.uint64)])
            shared = size - drop
            if len(b) and shared * 100 >= 85 * (size + len(b) - shared):
                keys = [
                    {k for band in bands.joined(len(s)) for k in parity.slice_keys(np.unique(s), band, bands).tolist()} for s in (a, b)
                ]
                assert keys[0] & keys[1], size
            x, y = (np.frombuffer(parity.dense_sketch(np.unique(s)), np.uint64) for s in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= len(set(a.tolist()) ^ set(b.tolist()))


def test_drop_similar_keeps_one_of_each_group(spark):
    rows = awkward_rows() + family(random.Random(9), 500, 30, 80, 1)
    docs = documents(spark, rows)
    out = parity.drop_similar(docs)
    assert out.columns == docs.columns
    want = {(i, t) for (i, _, c), (_, t, _) in zip([x for x in brute_force_in_order(rows)], rows, strict=True) if i == c}
    assert {(r.doc_id, r.text) for r in out.collect()} == want


def brute_force_in_order(rows):
    found = {}
    for i, n, c in brute_force(rows, 5, Fraction(4, 5)):
        found.setdefault((i, n), c)
    return [(i, len(shingles(t, 5)), found[i, len(shingles(t, 5))]) for i, t, _ in rows]


def test_bins_grow_with_the_rows_that_blocks_make(spark, monkeypatch):
    monkeypatch.setattr(parity, "BLOCK", 8)
    monkeypatch.setattr(parity, "SMALL_KEY", 3)
    groups, judged = [], parity._Join.hot_pairs
    rnd = random.Random(12)
    docs = documents(spark, family(rnd, 0, 120, 40, 1))

    def pairs(self, hot, parts, keep):
        made = sum(-(-r.nodes // parity.BLOCK) for r in hot.collect())
        groups.append((parity.hot_bins(hot), made))
        return judged(self, hot, parts, keep)

    monkeypatch.setattr(parity._Join, "hot_pairs", pairs)
    parity.group_similar(docs).collect()
    assert groups and all(bins >= made / (2 * parity.BLOCK) for bins, made in groups)


def test_empty(spark):
    assert parity.group_similar(spark.createDataFrame([], SCHEMA)).count() == 0
    assert parity.drop_similar(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_random_graphs_and_a_path(spark):
    rnd = random.Random(2)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(300 + i, 301 + i) for i in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = components_by_hand(400, links)
    assert got == {i: want[i] for i in {x for a, b in links if a != b for x in (a, b)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
