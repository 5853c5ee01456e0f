from __future__ import annotations

import hashlib
import string

from fairgauge.llm import contentsort
from llm_tables import SCHEMA, awkward_rows, documents

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute_force(rows, pick):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault((t or "").translate(FOLD), []).append(i)
    return {t: (pick([i for i in ids if i is not None], default=None), len(ids)) for t, ids in groups.items()}


def check(spark, rows, keep):
    got = contentsort.group_copies(documents(spark, rows), keep).collect()
    want = brute_force(rows, max if keep == "largest" else min)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id, r.group_size) == by_sha[r.text_sha256]
        assert not r.kept or r.doc_id == r.keep_id
    kept = [r.text_sha256 for r in got if r.kept]
    assert sorted(kept) == sorted(by_sha)


def test_awkward_rows_either_way(spark):
    check(spark, awkward_rows(), "largest")
    check(spark, awkward_rows(), "smallest")


def test_hot_group_and_shared_beginnings(spark):
    same = "A very common first line of texts that go on differently "
    rows = [(i, "Copy of one text", "a") for i in range(300)] + [(1000 + i, same + str(i % 40), "a") for i in range(200)]
    check(spark, rows, "largest")


def test_drop_copies_keeps_columns(spark):
    docs = documents(spark, awkward_rows())
    out = contentsort.drop_copies(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len({(r.text or "").translate(FOLD) for r in rows}) == len(rows) == len(brute_force(awkward_rows(), min))
    assert {r.doc_id for r in rows if r.text and r.text.lower() == "one"} == {4}


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert contentsort.group_copies(empty).count() == 0
    assert contentsort.drop_copies(empty).count() == 0
