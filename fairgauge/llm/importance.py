"""Quality classifier by importance resampling (operator 1).

Two generative models over hashed n-grams, one of target text (documents labelled as
good) and one of all raw text, give each document the log ratio of its probabilities:
its importance weight. Documents are then drawn without replacement in proportion to
their weights by Gumbel top-k: the k largest sums of log weight and Gumbel noise stay,
the noise a fixed function of id and seed, so that reruns agree.

n-grams are taken of words (one and two of them) and of word shapes (one to three of
them): length class, letter case, marks at the end and inside, digits, and whether the
word before is repeated. Words tell subject and language, shapes tell running text
from lists, shouting, symbols and repetitions, whatever the language.

k is the number of documents whose weight lies above the cut that tells labelled good
from labelled rejected rows with fewest errors, halfway between the rows around it,
and never above minus log 2, so that no text is rejected for being short.
Exact at any size: the k-th key is found by counting keys in ever finer ranges, never
by sorting all.

The target model and the cut are fitted on at most ``SAMPLE_ROWS`` labelled rows of
each class, those of least id hash; the good rows of the cut are kept from the model.
The raw model counts every document.

Defined cases: a null or empty text has log weight 0; rows of one id share their noise;
rows with the k-th key all stay; an id labelled both ways counts as rejected; without
labelled rows of both classes every row stays; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairgauge.llm.common import materialise
from fairgauge.llm.words import Words, chunks, mix, words_of

#: Labelled rows of a class that the target model and the cut see at most.
SAMPLE_ROWS = 20_000
#: Buckets of the word model and of the shape model.
BUCKETS = 1 << 13
#: The target model is drawn towards the raw one as if it had seen so many more n-grams of
#: raw text per bucket: many of words, most of which are rare, few of shapes.
PRIOR = (50.0, 5.0)
#: Of the sampled good rows, one in so many is kept from the model for the cut.
CUT_PART = 4
SEED = 17

_CLASS = np.zeros((5, 256), np.int64)  # lower case, upper case, digit, ASCII mark, other
_CLASS[0, 97:123] = _CLASS[1, 65:91] = _CLASS[2, 48:58] = _CLASS[4, 128:] = 1
_CLASS[3, [c for c in range(33, 127) if not chr(c).isalnum()]] = 1


def _shapes(w: Words) -> np.ndarray:
    """A small number per word for how it is written."""
    n = w.ends - w.starts

    def count(kind: int) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(_CLASS[kind][w.data])])
        return sums[w.ends] - sums[w.starts]

    lower, upper, digits, marks = (count(k) for k in range(4))
    tail = np.zeros(len(n), np.int64)
    for k in (1, 2, 3):
        tail += (tail == k - 1) & (n >= k) & (_CLASS[3][w.data[np.maximum(w.ends - k, 0)]] > 0)
    first_upper = _CLASS[1][w.data[w.starts]] > 0
    case = np.where(upper == 0, 0, np.where((lower == 0) & (upper > 1), 3, np.where(first_upper & (upper == 1), 1, 2)))
    length = np.digitize(n - marks, [1, 3, 6, 10, 16, 40])
    again = np.zeros(len(n), bool)
    again[1:] = w.hashes[1:] == w.hashes[:-1]
    again[w.first[:-1][w.first[:-1] < len(n)]] = False
    code = length
    for part, base in ((case, 4), (tail, 4), (np.minimum(marks - tail, 2), 3), (digits > 0, 2), (again, 2)):
        code = code * base + part
    return code


def _grams(values: np.ndarray, w: Words, n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive values of one text, and the text of each."""
    m = len(values) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = w.doc
    whole = doc[:m] == doc[n - 1 :]
    h = np.full(m, salt, np.uint64)
    for k in range(n):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + values[k : k + m])
    return h[whole], doc[:m][whole]


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every n-gram."""
    shapes = _shapes(w).astype(np.uint64)
    parts = [(_grams(w.hashes, w, n, n), 0) for n in (1, 2)] + [(_grams(shapes, w, n, 8 + n), BUCKETS) for n in (1, 2, 3)]
    buckets = [(h % np.uint64(BUCKETS)).astype(np.int64) + offset for (h, _), offset in parts]
    return np.concatenate(buckets), np.concatenate([doc for (_, doc), _ in parts])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, good = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
    for batch in batches:
        for part, texts in chunks(batch):
            target = part.column("target").to_numpy(zero_copy_only=False).astype(bool)
            bucket, doc = features(words_of(texts))
            raw += np.bincount(bucket, minlength=2 * BUCKETS)
            good += np.bincount(bucket[target[doc]], minlength=2 * BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_pydict({"bucket": some.astype(np.int32), "raw": raw[some], "good": good[some]})


def _scores(batches: Iterator[pa.RecordBatch], ratio: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in chunks(batch):
            bucket, doc = features(words_of(texts))
            weight = np.bincount(doc, weights=ratio[bucket], minlength=len(texts)).astype(float)  # long if all are empty
            others = [part.column(i) for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*others, pa.array(weight)], names=[*part.schema.names[:-1], "log_weight"])


def log_ratio(docs: DataFrame, target_ids: DataFrame) -> np.ndarray:
    """Log ratio of each bucket. ``docs``: id, text; ``target_ids``: bounded, distinct ids."""
    marked = docs.join(F.broadcast(target_ids.withColumn("target", F.lit(True))), "id", "left").select(
        "text", F.coalesce("target", F.lit(False)).alias("target")
    )
    rows = (
        marked.mapInArrow(_counts, "bucket int, raw long, good long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
        .collect()  # a row per bucket
    )
    counts = np.zeros((2, 2, BUCKETS))
    for r in rows:
        counts[0, r.bucket // BUCKETS, r.bucket % BUCKETS] = r.raw
        counts[1, r.bucket // BUCKETS, r.bucket % BUCKETS] = r.good
    out = np.zeros((2, BUCKETS))
    for k, (raw, good) in enumerate(zip(*counts, strict=True)):
        if good.any():
            prior, p = PRIOR[k] * BUCKETS, np.maximum(raw, 1) / raw.sum()  # a bucket without raw text is never looked up
            out[k] = np.log((good / p + prior) / (good.sum() + prior))
    return out.ravel()


def gumbel(id_: Column, seed: int) -> Column:
    """Standard Gumbel noise as a function of the id."""
    u = (F.pmod(F.xxhash64(id_, F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(keys: DataFrame, k: int, key: str = "key", ranges: int = 1024) -> float:
    """The k-th largest of finite doubles by counting in ever finer ranges."""
    if k <= 0:
        return math.inf
    low, high = keys.agg(F.min(key), F.max(key)).first()
    if low is None:
        return -math.inf
    while low < high:
        width = (high - low) / ranges
        if low + width == low:
            break
        place = F.least(F.floor((F.col(key) - low) / width), F.lit(ranges - 1)).cast("int")
        rows = (
            keys.where((F.col(key) >= low) & (F.col(key) <= high))
            .groupBy(place.alias("place"))
            .agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
            .collect()  # at most ``ranges`` rows
        )
        for r in sorted(rows, key=lambda r: -r.place):
            if k <= r.n:
                break
            k -= r.n
        low, high = r.low, r.high
    return low


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The weight that splits the classes with fewest errors: the middle of the widest
    such gap between two rows."""
    if not len(good) or not len(bad):
        return -math.inf
    values = np.sort(np.concatenate([good, bad]))
    edges = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    gaps = np.concatenate([[0], np.diff(values), [0]])
    errors = np.searchsorted(np.sort(good), edges) + len(bad) - np.searchsorted(np.sort(bad), edges)
    best = np.flatnonzero(errors == errors.min())
    return float(edges[best[gaps[best].argmax()]])


def labelled_sample(labels: DataFrame, id_col: str, sample_rows: int, seed: int) -> DataFrame:
    """id, ``good`` and ``for_cut`` of at most ``sample_rows`` rows of each class."""
    rated = (
        labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.min("quality") == 1).alias("good"))
    )
    some = [rated.where(F.col("good") == x).orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample_rows) for x in (True, False)]
    for_cut = ~F.col("good") | (F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(CUT_PART)) == 0)
    return some[0].unionByName(some[1]).withColumn("for_cut", for_cut)


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS, seed: int = SEED,
    rows: bool = False,
) -> DataFrame:
    """``id_col``, log_weight, key and kept of each document; with ``rows``, the kept
    documents in their own columns. ``labels`` has ``id_col`` and ``quality``."""
    texts = docs.select(F.col(id_col).alias("id"), "text")
    sample = materialise(labelled_sample(labels, id_col, sample_rows, seed), "importance-sample")
    ratio = log_ratio(texts, sample.where(~F.col("for_cut")).select("id"))

    def score(frame: DataFrame) -> DataFrame:
        schema = frame.drop("text").schema.add("log_weight", "double")
        scored = frame.mapInArrow(lambda x: _scores(x, ratio), schema)
        return scored.withColumn("key", F.col("log_weight") + gumbel(F.col("id"), seed))

    scored = materialise(score(texts), "importance")
    known = scored.join(F.broadcast(sample.where("for_cut")), "id").groupBy("id", "good").agg(F.min("log_weight").alias("w")).collect()
    cut = best_cut(np.array([r.w for r in known if r.good]), np.array([r.w for r in known if not r.good]))
    cut = min(cut, -math.log(2))
    bound = kth_largest(scored.select("key"), scored.where(F.col("log_weight") > cut).count())
    if not rows:
        return scored.select(F.col("id").alias(id_col), "log_weight", "key", (F.col("key") >= bound).alias("kept"))
    again = docs.select(F.col(id_col).alias("id"), F.struct("*").alias("row"), "text")
    return score(again).where(F.col("key") >= bound).select("row.*")
