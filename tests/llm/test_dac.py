from __future__ import annotations

import numpy as np
from fairgauge.llm import dac
from fairgauge.llm.common import scratch_path
from fairgauge.llm.tokens import default_path, encoder
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tables import SCHEMA, awkward_rows, documents


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
def test_round_trip_and_random_access(values):
    coded = dac.Dac(dac.Dac.encode(np.array(values, np.uint32)))
    assert coded.decode().tolist() == values
    assert [coded.get(i) for i in range(len(values))] == values


def test_widths_are_least():
    values = np.concatenate([np.arange(200), np.full(50, 40_000)]).astype(np.uint32)
    def size(widths):
        left, bits = values, 0
        for k, w in enumerate(widths):
            last = k == len(widths) - 1
            bits += len(left) * (w + (0 if last else 1 + 32 / dac.BLOCK))
            left = left[left >> np.uint32(sum(widths[: k + 1]) - sum(widths[:k])) > 0] >> np.uint32(w)
        return bits
    def splits(n):
        return [[n]] + [[i, *rest] for i in range(1, n) for rest in splits(n - i)]
    best = dac.best_widths(values)
    assert sum(best) == 16
    assert size(best) == min(map(size, splits(16)))


def check(spark, rows, shard_tokens):
    path = scratch_path(spark, "test-dac")
    dac.write_tokens(documents(spark, rows), path, shard_tokens=shard_tokens)
    got = dac.read_tokens(spark, path).collect()
    enc = encoder(default_path())
    want = sorted((i if i is not None else -1, enc.whole(t or "") + b"\x02\0\0\0") for i, t, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.ids)) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    ordered = [r.doc_id if r.doc_id is not None else -1 for r in sorted(got, key=lambda r: r.start)]
    assert ordered == sorted(ordered)


def test_files_hold_all_documents_in_order(spark):
    check(spark, awkward_rows(), dac.SHARD_TOKENS)
    check(spark, awkward_rows() + [(100 - i, f"text {i}", "a") for i in range(50)], 40)


def test_empty(spark):
    path = scratch_path(spark, "test-dac")
    dac.write_tokens(spark.createDataFrame([], SCHEMA), path)
    assert dac.read_tokens(spark, path).count() == 0
