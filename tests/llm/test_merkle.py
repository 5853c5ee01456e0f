"""The Merkle manifest (operator 11) against a tree built level by level in lists."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairgauge.llm import merkle
from fairgauge.llm.common import scratch_path
from fairgauge.llm.oracle import ORACLE_SQL
from fairgauge.llm.queries import QUERIES
from tests.compare import compare, duck
from tests.conftest import SF_SMALL
from tests.llm.llm_tables import CLASHES, SCHEMA, awkward_rows, documents


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, n_chars):
    values = [row["doc_id"], row["source"], row["lang"], n_chars, row["text"]]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    """Levels from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([H("".join(row[k : k + 2])) for k in range(0, len(row), 2)])
    return levels


def climb(levels, at, start):
    proof, cur = "", start
    for row in levels[:-1]:
        other = row[at ^ 1] if at ^ 1 < len(row) else ""
        cur = H(other + cur if at % 2 else cur + other)
        proof, at = proof + other, at // 2
    return proof, cur


def plain(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r["lang"]].append((r["doc_id"], plain_leaf(r, r["n_chars"]), r))
    keys = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for k in keys:
        trees[k].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        built[k] = plain_tree([x[1] for x in trees[k]])
    top = plain_tree([built[k][-1][0] for k in keys])
    out = []
    for place, k in enumerate(keys):
        for at, (doc_id, leaf, r) in enumerate(trees[k]):
            n = r["n_chars"]
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n is not None:
                n += 1
            proof, cur = climb(built[k], at, plain_leaf(r, n))
            more, cur = climb(top, place, cur)
            out.append((doc_id, leaf, built[k][-1][0], top[-1][0], H(proof + more), cur, cur == top[-1][0]))
    return sorted(out, key=repr)


def proofs(spark, docs, height):
    tampered = merkle.leaf(changed={"n_chars": F.col("n_chars") + 1})
    shown = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, tampered).otherwise(merkle.leaf())
    manifest = merkle.write_manifest(docs, scratch_path(spark, "test-merkle"), height=height, carried={"presented": shown})
    return merkle.prove(manifest, "presented")


@pytest.mark.parametrize("levels", range(1, 9))
def test_layout(levels):
    places = np.concatenate(merkle.addresses(levels))
    assert sorted(places.tolist()) == list(range(2**levels - 1))
    if levels > 1:  # the top half stands first, then each subtree of the rest in one run
        top = levels // 2
        assert max(np.concatenate(merkle.addresses(levels)[:top])) == 2**top - 2
        for k in range(2**top):
            run = np.concatenate([merkle.addresses(levels)[top + d][k << d : (k + 1) << d] for d in range(levels - top)])
            assert run.max() - run.min() == 2 ** (levels - top) - 2
            assert (run - run.min()).tolist() == np.concatenate(merkle.addresses(levels - top)).tolist()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 11])
def test_block(n):
    leaves = [H(str(k)) for k in range(n)]
    nodes, root, up = merkle.build_block(leaves, 5)
    levels = plain_tree(leaves)
    assert root == levels[-1][0]
    for _ in range(5 - (len(levels) - 1)):
        root = H(root)
    assert up == root
    assert merkle.siblings(nodes, n) == [[row[k ^ 1] if k ^ 1 < len(row) else "" for k in range(len(row))] for row in levels[:-1]]


@pytest.mark.parametrize("height", [1, 2, 12])
def test_proofs_against_plain(spark, height):
    rnd = random.Random(6)
    rows = [(i, t, None, s, None if t is None else len(t), *["x"] * len(CLASHES)) for i, t, s in awkward_rows()]
    langs = ["de", "en", "é", "", "zz"]
    for k in range(90):
        lang = rnd.choice(langs[:4]) if rnd.random() < 0.6 else "en"
        rows.append((1000 + rnd.randrange(200), f"text {k}", lang, "s", rnd.choice([None, 5, 6]), *["y"] * len(CLASHES)))
    rows.append((2**60 + 1, "far", "zz", None, 3, *["y"] * len(CLASHES)))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r) for r in proofs(spark, docs.repartition(4), height).collect()), key=repr)
    assert got == plain([r.asDict() for r in docs.collect()])
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_one_row_and_none(spark):
    one = documents(spark, [(5, "alone", "s")])
    assert [tuple(r) for r in proofs(spark, one, 3).collect()] == plain([r.asDict() for r in one.collect()])
    assert proofs(spark, documents(spark, []), 3).collect() == []


def test_query_equals_sql(spark):
    name = "op11_merkle"
    s_cols, d_cols, s_rows, d_rows = compare(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE_SQL[name])
    assert s_cols == d_cols and s_rows == d_rows
    assert 0 < sum(not r[s_cols.index("verified")] for r in s_rows) < len(s_rows) / 4
