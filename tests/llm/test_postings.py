"""The positional index and decontamination (operator 12) against plain scans."""

import hashlib
import itertools
import random
import re

import pyarrow as pa
import pytest

from fairgauge.llm import alnum, postings
from fairgauge.llm.common import scratch_path
from fairgauge.llm.oracle import ORACLE_SQL
from fairgauge.llm.queries import QUERIES
from tests.compare import compare, duck
from tests.conftest import SF_SMALL
from tests.llm.llm_tables import awkward_rows, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, bench, window):
    """(doc_id, n_words, n_hit, items) by looking at every place."""
    wanted = {}
    for item, text in bench:
        w = words(text)
        runs = [tuple(w[i : i + window]) for i in range(len(w) - window + 1)] or ([tuple(w)] if w else [])
        for run in runs:
            wanted.setdefault(run, set()).add(item)
    sizes = {len(r) for r in wanted}
    out = []
    for i, text in docs:
        w, hit, items = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (run := tuple(w[k : k + n])) in wanted:
                    hit.update(range(k, k + n))
                    items |= wanted[run]
        out.append((i, len(w), len(hit), tuple(sorted(str(x) for x in items if x is not None))))
    return sorted(out, key=repr)


def case():
    rnd = random.Random(8)
    passages = [prose(rnd, rnd.randrange(12, 40)) for _ in range(6)]
    bench = [(k, p) for k, p in enumerate(passages)] + [(6, "Three short words"), (7, None), (8, "..."), (9, passages[0]),
             (10, passages[1].upper()), (None, passages[2]), (11, "a a a a a a a a a a a a"), (1, passages[3]), (12, "lone")]
    docs = [(i, t) for i, t, _ in awkward_rows()]
    for k, p in enumerate(passages):
        w = p.split()
        docs += [(100 + k, prose(rnd, 30) + " " + p.title() + "! " + prose(rnd, 5)), (200 + k, " - ".join(w[1:11])), (300 + k, " ".join(w[1:10]))]
        docs += [(400 + k, " ".join([*w[:10], "gap", *w[-10:]])), (500 + k, p + "\n" + p)]
    docs += [(600, "one three short words and three short, words"), (601, "A " * 25), (602, "a a a"), (603, "lone LONE alone"),
             (700, " ".join(prose(rnd, 20) + " " + rnd.choice(passages) for _ in range(40)))]
    return docs, bench


@pytest.mark.parametrize("size,block", [(1 << 19, 1 << 16), (150, 1 << 16), (150, 7)])
def test_decontamination_against_plain(spark, monkeypatch, size, block):
    docs, bench = case()
    items = spark.createDataFrame(bench, "item_id long, text string")
    monkeypatch.setattr(postings, "BLOCK_QUERIES", block)
    for window in (10, 3) if size > 150 else (10,):
        got = postings.decontaminate(documents(spark, [(i, t, "s") for i, t in docs]).repartition(3), items, window, shard_bytes=size)
        rows = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got.collect()]
        assert sorted(rows, key=repr) == plain(docs, bench, window)
        assert all(r["contaminated"] == (r["n_hit"] > 0) for r in got.collect())


@pytest.fixture(scope="module")
def index(spark):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("abcdef") for _ in range(rnd.randrange(0, 120))) for _ in range(40)]
    path = scratch_path(spark, "test-postings")
    postings.write_index(documents(spark, [(k, t, "s") for k, t in enumerate(texts)]).coalesce(2), path, shard_bytes=60)
    return postings.read_index(spark, path), texts


def test_phrases(spark, index):
    table, texts = index
    phrases = [("p", "a b"), ("q", "c"), ("r", "f e d c"), ("s", "zz"), ("t", "a-A-a"), ("u", "")]
    got = postings.find_phrases(table, spark.createDataFrame(phrases, "query_id string, text string"))
    want = []
    for k, t in enumerate(texts):
        w = t.split()
        for name, p in phrases:
            q = words(p)
            want += [(k, name, i, len(q)) for i in range(len(w) - len(q) + 1) if q and w[i : i + len(q)] == q]
    assert sorted(tuple(r)[1:] for r in got.collect()) == sorted(want) and len(want) > 300


@pytest.mark.parametrize("terms,within", [(["a", "b", "c"], 5), (["f"], 3), (["a", "e"], 2), (["a", "zz"], 9), (list("abcdef"), 16)])
def test_near(index, terms, within):
    table, texts = index
    want = []
    for k, t in enumerate(texts):
        w = t.split()
        runs = [(i, j) for i, j in itertools.combinations_with_replacement(range(len(w)), 2) if j - i < within and set(terms) <= set(w[i : j + 1])]
        short = [(i, j) for i, j in runs if (i + 1, j) not in runs and (i, j - 1) not in runs]
        want += [(k, i, j - i + 1) for i, j in short]
    assert sorted(tuple(r)[1:] for r in postings.find_near(table, terms, within).collect()) == sorted(want)


@pytest.mark.parametrize("size", [1, 30, 1 << 19])
def test_windows_of_long_items(monkeypatch, size):
    monkeypatch.setattr(postings, "blocks", lambda t, overlap: alnum.blocks(t, overlap, size))
    _, bench = case()
    texts = [t for _, t in bench] + ["x" * 200 + " " + "y" * 100, "x" * 200 + " b " + "y" * 100 + " c"]
    batch = pa.RecordBatch.from_arrays([pa.array([str(k) for k in range(len(texts))]), pa.array(texts)], names=["name", "text"])
    got = [tuple(r.values()) for b in postings._windows(iter([batch]), 3) for r in b.to_pylist()]
    want = []
    for k, t in enumerate(texts):
        w = words(t)
        want += [(str(k), " ".join(w[i : i + 3])) for i in range(len(w) - 2)] or ([(str(k), " ".join(w))] if w else [])
    assert sorted(got) == sorted(want)


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert postings.decontaminate(documents(spark, []), bench).collect() == []
    got = postings.decontaminate(documents(spark, [(1, "a b", "s"), (2, None, "s")]), bench).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got) == [(1, 2, 0, []), (2, 0, 0, [])]


def test_windows_and_phrases_beyond_the_reach_are_refused(spark):
    docs = documents(spark, [(1, "a", "s")])
    with pytest.raises(ValueError):
        postings.decontaminate(docs, spark.createDataFrame([(1, "a")], "item_id long, text string"), postings.REACH + 1)


def test_query_equals_sql(spark):
    name = "op12_postings"
    s_cols, d_cols, s_rows, d_rows = compare(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE_SQL[name])
    assert s_cols == d_cols and s_rows == d_rows
    hit = QUERIES[name](spark, SF_SMALL).where("contaminated").collect()
    assert hit and all(r["items_sha256"] != hashlib.sha256(b"").hexdigest() for r in hit)
