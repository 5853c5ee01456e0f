from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
from fairgauge.llm import packing
from fairgauge.llm.tokens import default_path, encoder
from llm_tables import SCHEMA, awkward_rows, documents


def test_cut():
    assert packing.cut(1, 8) == [(0, 1)]
    assert packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(17, 8) == [(0, 1), (1, 8), (9, 8)]
    assert packing.cut(24, 8) == [(0, 8), (8, 8), (16, 8)]


def test_each_choice_has_the_smallest_sum_of_squares():
    rng = np.random.default_rng(4)
    for capacity in (5, 16, 64):
        lengths = rng.integers(1, capacity + 1, 300)
        sequence, offset = packing.sum_of_squares(lengths, capacity)
        free: dict[int, int] = {}
        for s, q, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist(), strict=True):
            def total(gaps):
                return sum(n * n for g, n in Counter(gaps).items() if g)
            gaps = [g for g in free.values() if g]
            fits = {g for g in gaps if g >= s}
            if q in free:
                assert o == capacity - free[q] and free[q] in fits
                after = {g: total([x for k, x in enumerate(gaps) if k != gaps.index(g)] + [g - s]) for g in fits}
                assert after[free[q]] == min(after.values())
            else:
                assert not fits and o == 0
            free[q] = free.get(q, capacity) - s
            assert free[q] >= 0


def check(spark, rows, **options):
    got = packing.pack(documents(spark, rows), **options).collect()
    capacity = options.get("capacity", packing.CAPACITY)
    enc = encoder(default_path())
    want = Counter()
    for i, t, _ in rows:
        data = enc.whole(t or "") + b"\x02\0\0\0"
        for k, (a, n) in enumerate(packing.cut(len(data) // 4, capacity)):
            want[i, k, a, n, zlib.crc32(data[4 * a : 4 * (a + n)])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == np.cumsum([0] + [n for _, n in p[:-1]]).tolist()
        assert sum(n for _, n in p) <= capacity
    return places


def test_awkward_rows(spark):
    places = check(spark, awkward_rows())
    total = sum(n for p in places.values() for _, n in p)
    assert len(places) <= -(-total // packing.CAPACITY) + 1
    check(spark, awkward_rows(), capacity=16, group_pieces=5)


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0
