"""Length-bucketed CRC matrices and the draw (operator 13) against plain loops."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fairgauge.llm import alnum, lengthcrc
from fairgauge.llm.lengthcrc import feature_buckets, resample, span_crcs
from fairgauge.llm.oracle import ORACLE_SQL
from fairgauge.llm.queries import QUERIES
from tests.compare import compare, duck
from tests.conftest import SF_SMALL
from tests.llm.llm_tables import awkward_rows, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_features(text, shortest, longest):
    words = WORD.findall(fold(text))
    return [" ".join(words[i : i + n]) for n in range(shortest, longest + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("size", [1, 7, 1023, 1024, 1025, 5000])
def test_crc_of_rows(size):
    rng = np.random.default_rng(size)
    data = rng.integers(0, 256, 4 * size + 10, dtype=np.uint8)
    starts = np.array([0, 3, size, 0, 2 * size + 5])
    ends = starts + np.array([size, size, size, size, min(size, 6)])
    got = span_crcs(data, starts, ends)
    assert got.tolist() == [zlib.crc32(data[i:j].tobytes()) for i, j in zip(starts, ends)]


@pytest.mark.parametrize("shortest,longest", [(1, 1), (1, 3), (2, 2)])
@pytest.mark.parametrize("size", [1 << 19, 40])
def test_features_of_pieces(monkeypatch, shortest, longest, size):
    monkeypatch.setattr(alnum.blocks, "__defaults__", (0, size))
    texts = [t for _, t, _ in awkward_rows()] + ["", "a", "--", "é-É A9z", "x" * 300 + " y " * 40]
    found = [Counter() for _ in texts]
    for block, buckets, piece in feature_buckets(pa.array(texts), shortest, longest, 997):
        assert (np.diff(piece) >= 0).all()
        for b, p in zip(buckets.tolist(), piece.tolist()):
            found[block.rows[p]][b] += 1
    want = [Counter(zlib.crc32(f.encode()) % 997 for f in plain_features(t, shortest, longest)) for t in texts]
    assert found == want


def plain_resample(docs, target, share, least, shortest, longest, buckets, seed):
    count = [Counter(zlib.crc32(f.encode()) % buckets for t in ts for f in plain_features(t, shortest, longest))
             for ts in ([t for _, t in docs], target)]
    s, t = count
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows, able = [], []
    for i, text in docs:
        f = plain_features(text, shortest, longest)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None])
        if score is not None and len(WORD.findall(fold(text))) >= least:
            able.append((-score, i, len(f), len(rows) - 1))
    for rank, x in enumerate(sorted(able)[: share * len(able) // 100], 1):
        rows[x[3]][4] = rank
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("shortest,longest,buckets", [(1, 1, 10_000), (1, 2, 300)])
def test_resample_against_plain(spark, shortest, longest, buckets):
    rnd = random.Random(4)
    rows = awkward_rows() + [(100 + k, prose(rnd, rnd.randrange(0, 60)), "a") for k in range(150)]
    rows += [(77, prose(random.Random(1), 30), "b")] * 3
    target = [prose(rnd, 40), None, "", "changed ONE two"]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string")
    args = {"share": 30, "least_words": 20, "shortest": shortest, "longest": longest, "buckets": buckets, "seed": 5}
    got = resample(documents(spark, rows).repartition(5), bench, **args)
    want = plain_resample([(i, t) for i, t, _ in rows], target, 30, 20, shortest, longest, buckets, 5)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert sum(w[4] is not None for w in want) > 30


def test_empty_tables(spark):
    empty = documents(spark, [])
    bench = spark.createDataFrame([], "item_id int, text string")
    assert resample(empty, bench).collect() == []
    got = resample(documents(spark, [(1, "a b", "x"), (2, None, "x")]), bench).collect()
    assert sorted((r["doc_id"], r["n_features"], r["rank"]) for r in got) == [(1, 2, None), (2, 0, None)]


def test_long_text_is_worked_through_in_pieces():
    text = ("lorem ipsum dolor " * 300_000).encode()
    sizes = [len(b.data) for b in alnum.blocks(pa.array([text]))]
    assert max(sizes) < alnum.PIECE_BYTES + 64 and sum(sizes) < len(text) + 10 * len(sizes)


def test_query_equals_sql(spark):
    name = "op13_length_crc"
    s_cols, d_cols, s_rows, d_rows = compare(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE_SQL[name])
    assert s_cols == d_cols and s_rows == d_rows
    assert sum(r[s_cols.index("rank")] is not None for r in s_rows) > 5
