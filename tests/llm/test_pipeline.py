"""The pipeline's stages on a small table, each against brute force on its own input,
and the registered queries against DuckDB."""

from __future__ import annotations

import random
import string
import sys
from collections import Counter
from fractions import Fraction
from pathlib import Path

import pytest
from fairgauge.llm import importance
from fairgauge.llm.oracle import ORACLE_SQL
from fairgauge.llm.queries import QUERIES
from llm_tables import SCHEMA, awkward_rows, documents, prose
from test_parity import brute_force, shingles

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402

SMALL = "/root/testdata/sf0.001"
FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(12)
    rows = [r if r[0] is None else (r[0] + 1000, *r[1:]) for r in awkward_rows()]
    rows += [(i, prose(rnd, rnd.randrange(20, 80)), rnd.choice(["a", "b", None])) for i in range(60)]
    rows += [(100 + i, " ".join([prose(rnd, 1)] * 40), "a") for i in range(20)]
    rows += [(200 + i, rows[30 + i][1], "c") for i in range(10)] + [(300 + i, rows[30 + i][1] + " tail", "c") for i in range(10)]
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=repr)


def test_stages_take_effect_on_all_that_is_left(spark, folder):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "mix", "pack"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    good = stages["quality"](spark, docs, folder)
    scores = importance.classify(docs, spark.read.parquet(f"{folder}/labels.parquet")).where("kept")
    assert Counter(r.doc_id for r in good.collect()) == Counter(r.doc_id for r in scores.collect())
    left = {r.doc_id for r in good.collect()}
    assert set(range(60)) <= left and not left & set(range(100, 120))

    once = stages["exact_dedup"](spark, good, folder)
    want = {}
    for i, t, s in rows_of(good):
        key = (t or "").translate(FOLD)
        if key not in want or want[key][0] is None or (i is not None and i < want[key][0]):
            want[key] = (i, t, s)
    assert [i for i, _, _ in rows_of(once)] == sorted((i for i, _, _ in want.values()), key=repr)

    apart = stages["near_dedup"](spark, once, folder)
    groups = brute_force(rows_of(once), 5, Fraction(4, 5))
    assert sorted((r.doc_id, len(shingles(r.text, 5))) for r in apart.collect()) == sorted((i, n) for i, n, c in groups if i == c)
    assert not {r.doc_id for r in apart.collect()} & set(range(300, 310))

    mixed = stages["mix"](spark, apart, folder)
    counts = Counter(r.doc_id for r in mixed.collect())
    texts = Counter((r.doc_id, r.text) for r in mixed.collect())  # one id has two texts
    assert texts and set(texts) <= {(r.doc_id, r.text) for r in apart.collect()} and set(texts.values()) <= {1, 2}
    for step in (good, once, apart, mixed):
        assert step.columns == docs.columns

    packed = stages["pack"](spark, mixed, folder).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == counts
    assert max(Counter(r.sequence_id for r in packed).values()) > 1
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, folder).collect() if r.piece == 0) == counts


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_are_registered():
    found = entry.queries()
    assert "pipeline" in found and set(QUERIES) <= set(found) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    from compare import compare, duck

    columns, wanted, rows, expected = compare(QUERIES[name](spark, SMALL), duck(SMALL), ORACLE_SQL[name])
    assert columns == wanted and rows == expected
