"""Target-distribution importance resampling by length-bucketed CRC matrices (operator 13).

Features of a text are its runs of ``shortest`` to ``longest`` consecutive words joined by
one space, repeats counted; a feature's bucket is the CRC-32 of its bytes modulo
``buckets``. All CRCs of a block of texts are worked out at once: the features of equal
length form the rows of a two-dimensional uint8 matrix, equal rows are merged, the CRCs of
all rows are brought forward column by column, and the buckets are scattered back to the
features. Long features are rows of several blocks each, joined by the shift of a CRC over
a block, which is linear.

Bucket counts of the raw and the target texts give each bucket's gain, a text's weight is
the mean gain of its features, and a Gumbel value drawn from its id makes the ``share`` of
texts with the highest scores a sample by weight without replacement.

What grows with the data: one row per bucket and task is shuffled to be counted, gains are
``buckets`` numbers. Scores are integers of a bounded range, so the score that the draw
ends at is read off their histogram; the rows above it are range-sorted to be ranked.

Defined cases: a null or empty text has no features and weight 0; a text of fewer than
``least_words`` words is scored but never drawn; a row without id has no score and isn't
counted for the draw; rows of equal id and text are equal in score and are drawn one by
one; an empty table gives an empty result, an empty target gains from the raw counts alone;
other columns are ignored. A text of any length is worked through in pieces of half a MB.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairgauge.llm.alnum import SPACE, Block, blocks, equal_rows
from fairgauge.llm.common import materialise, number_rows

BUCKETS = 10_000
#: Columns of a matrix; longer features take several rows.
MOST_COLUMNS = 1024

# The reversed polynomial of CRC-32 and its first and last mask.
POLYNOMIAL, MASK = 0xEDB88320, np.uint32(0xFFFFFFFF)


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    """CRC of each byte value."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(POLYNOMIAL), value >> 1)
    return value


def _forward(state: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The states (one per row) after a matrix's bytes; ``columns``: a row of it per column."""
    table = _table()
    for column in columns:
        state = table[(state ^ column) & 0xFF] ^ (state >> np.uint32(8))
    return state


@lru_cache(maxsize=1)
def _shift() -> np.ndarray:
    """Each bit of a state after ``MOST_COLUMNS`` zero bytes."""
    return _forward(np.uint32(1) << np.arange(32, dtype=np.uint32), np.zeros((MOST_COLUMNS, 32), np.uint8))


def _shifted(state: np.ndarray) -> np.ndarray:
    bits = (state[:, None] >> np.arange(32, dtype=np.uint32)) & 1
    return np.bitwise_xor.reduce(np.where(bits == 1, _shift(), np.uint32(0)), axis=1)


def crc_rows(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of each row."""
    n, width = matrix.shape
    head = width % MOST_COLUMNS
    state = _forward(np.full(n, MASK, np.uint32), np.ascontiguousarray(matrix[:, :head].T))
    if width > head:
        cut = matrix[:, head:].reshape(-1, MOST_COLUMNS)
        parts = _forward(np.zeros(len(cut), np.uint32), np.ascontiguousarray(cut.T)).reshape(n, -1)
        for k in range(parts.shape[1]):
            state = _shifted(state) ^ parts[:, k]
    return state ^ MASK


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each ``data[start:end]``."""
    lengths, out = ends - starts, np.zeros(len(starts), np.uint32)
    if not len(starts):
        return out
    by_length = np.argsort(lengths, kind="stable")
    sizes, at = np.unique(lengths[by_length], return_index=True)
    for size, i, j in zip(sizes.tolist(), at.tolist(), [*at[1:].tolist(), len(starts)], strict=True):
        # Rows of a matrix have about as many bytes in all as the block has.
        some = max(1, len(data) // max(1, size))
        for k in range(i, j, some):
            which = by_length[k : min(j, k + some)]
            matrix = data[starts[which][:, None] + np.arange(size)]
            once, inverse = equal_rows(matrix)
            out[which] = crc_rows(matrix[once])[inverse]
    return out


def _features(block: Block, shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with one space behind each word, starts and ends of the features in them, and
    their pieces in ascending order. A run that ends in a carried word is left out: the
    piece before has it."""
    lengths = block.ends - block.starts
    ends = np.cumsum(lengths + 1)
    starts = ends - lengths - 1
    kept = block.data != SPACE
    kept[block.ends] = True
    data = block.data[kept]
    piece = block.piece
    place = np.arange(len(starts)) - block.first[piece] if len(starts) else starts
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for n in range(shortest, longest + 1):
        i = np.arange(max(0, len(starts) - n + 1))
        j = i + n - 1
        good = (piece[i] == piece[j]) & (place[j] >= block.carried[piece[j]])
        found.append((starts[i[good]], ends[j[good]] - 1, piece[i[good]]))
    begin, end, of = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(of, kind="stable")
    return data, np.stack([begin[order], end[order]]), of[order]


def feature_buckets(
    texts: pa.Array, shortest: int, longest: int, buckets: int
) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
    """For each block of the texts: the block, each feature's bucket and its piece."""
    for block in blocks(texts, overlap=longest - 1):
        if shortest == longest == 1:  # words as they stand
            of = block.piece
            place = np.arange(len(of)) - block.first[of] if len(of) else of
            new = place >= block.carried[of]
            data, spans, of = block.data, np.stack([block.starts[new], block.ends[new]]), of[new]
        else:
            data, spans, of = _features(block, shortest, longest)
        yield block, (span_crcs(data, spans[0], spans[1]) % np.uint32(buckets)).astype(np.int64), of


def bucket_counts(texts: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all features of the column ``text``; each task counts its own
    before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found, _ in feature_buckets(batch.column(0), shortest, longest, buckets):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the raw."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, into in ((raw, s), (target, t)):
        for bucket, n in counts.collect():  # at most a row per bucket
            into[bucket] = n
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(
    docs: DataFrame, gain: np.ndarray, shortest: int = 1, longest: int = 1, id_col: str = "doc_id"
) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, sums = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for block, found, piece in feature_buckets(batch.column(1), shortest, longest, buckets):
                row = block.rows[piece]
                np.add.at(n_words, block.rows, np.diff(block.first) - block.carried)
                if len(row):
                    turn = np.flatnonzero(np.diff(row, prepend=-1))
                    n_features[row[turn]] += np.diff(np.append(turn, len(row)))
                    sums[row[turn]] += np.add.reduceat(gain[found], turn)
            weight = np.where(n_features > 0, sums // np.maximum(n_features, 1), 0)
            columns = [batch.column(0), *map(pa.array, (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int, row_id: Column) -> Column:
    """1000 times a standard Gumbel value, floored, drawn from seed and id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), row_id.cast("string")), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, share: int = 10, least_words: int = 20, shortest: int = 1, longest: int = 1,
    buckets: int = BUCKETS, seed: int = 2024, id_col: str = "doc_id",
) -> DataFrame:
    """A row per document: doc_id, n_features, weight, score and, for the ``share`` percent
    of those of ``least_words`` that are drawn, rank from 1."""
    count = [bucket_counts(x, shortest, longest, buckets) for x in (docs, target)]
    gain = gains(*count, buckets)
    weighed = weights(docs, gain, shortest, longest, id_col)
    scored = materialise(weighed.withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id"))), "scored")
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    # Gains and Gumbel values have a bounded range, so there are some 100,000 scores at most.
    histogram = sorted(scored.where(able).groupBy("score").count().collect(), reverse=True)
    drawn = share * sum(n for _, n in histogram) // 100
    cut, above = None, 0
    for score, n in histogram:
        if above >= drawn:
            break
        cut, above = score, above + n
    columns = ["doc_id", "n_features", "weight", "score"]
    if cut is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    reached = able & (F.col("score") >= cut)
    order = [F.col("score").desc(), F.col("doc_id"), F.col("n_features")]
    ranked = number_rows(scored.where(reached).select(*columns), order, "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    rest = scored.where(~F.coalesce(reached, F.lit(False)))
    return ranked.select(*columns, rank.alias("rank")).unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))
