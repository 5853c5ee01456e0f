"""Token files of directly addressable codes (operator 2).

A number is cut into chunks, lowest bits first, as many as it needs. Level 0 holds
every number's first chunk, level 1 the second chunk of those that have one, and so on;
a level's bitmap tells which of its numbers continue, and a rank directory (ones before
each block of 512 bits) gives the place of a number's next chunk. So any token is read
by a few look-ups, without decoding what stands before it. The chunk widths of a shard
are those of least size for the bit lengths it holds.

``write_tokens`` encodes whole texts and writes a table of shards in ascending id
order; a shard is a self-contained byte string (layout below) beside the ids and
lengths of its documents, uncompressed, so that a reader addresses it in place.
``read_tokens`` gives the documents back, ``Dac.get`` single tokens.

    magic "DAC1", levels (u8), then for each level: width (u8), numbers (u64);
    then for each level: chunks (packed, low bits first), and, but for the last,
    bitmap (numbers / 8 bytes) and directory (u32 for each 512 numbers)

Defined cases: a null text counts as empty and holds the end id alone; rows of one id
are ordered by a hash of their text; null ids come first; an empty table gives an empty
table; a document longer than a shard makes a shard of its own.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairgauge.llm.tokens import default_path, encoder

MAGIC = b"DAC1"
BLOCK = 512
#: A shard is closed once it holds so many tokens.
SHARD_TOKENS = 1 << 18
SHARD_SCHEMA = "part int, seq int, start long, doc_ids array<bigint>, lengths array<bigint>, codes binary"


def _pack(values: np.ndarray, width: int) -> bytes:
    octets = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(octets, axis=1, count=width, bitorder="little"), bitorder="little").tobytes()


def _unpack(data: memoryview, n: int, width: int) -> np.ndarray:
    full = np.zeros((n, 32), np.uint8)
    packed = np.frombuffer(data, np.uint8)
    full[:, :width] = np.unpackbits(packed, count=n * width, bitorder="little").reshape(n, width)
    return np.packbits(full, axis=1, bitorder="little").view("<u4").ravel()


def best_widths(values: np.ndarray) -> list[int]:
    """Chunk widths of least total size."""
    lengths = np.bincount(np.ceil(np.log2(values.astype(np.float64) + 1)).astype(int), minlength=33)
    top = max(1, int(np.flatnonzero(lengths).max(initial=0)))
    reach = [len(values), *(int(lengths[i + 1 :].sum()) for i in range(1, top))]  # numbers with bits from i on
    cost, cut = [0.0] * (top + 1), [0] * (top + 1)
    for i in range(top - 1, -1, -1):
        each = {j: reach[i] * (j - i + (1 + 32 / BLOCK) * (j < top)) + cost[j] for j in range(i + 1, top + 1)}
        cut[i] = min(each, key=each.get)
        cost[i] = each[cut[i]]
    widths, i = [], 0
    while i < top:
        widths.append(cut[i] - i)
        i = cut[i]
    return widths


class Dac:
    """A sequence of numbers below 2**32."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if bytes(view[:4]) != MAGIC:
            raise ValueError("not a DAC shard")
        self.levels, at = [], 5 + 9 * view[4]
        heads = [struct.unpack_from("<BQ", view, 5 + 9 * k) for k in range(view[4])]
        for k, (width, n) in enumerate(heads):
            parts, last = [], k == len(heads) - 1
            for size in ((n * width + 7) // 8, *(() if last else ((n + 7) // 8, 4 * (n // BLOCK + 1)))):
                parts.append(view[at : at + size])
                at += size
            self.levels.append((width, n, parts))

    def __len__(self) -> int:
        return self.levels[0][1]

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.asarray(values, dtype=np.uint32)
        widths = best_widths(values)
        heads, body = [], []
        for k, width in enumerate(widths):
            heads.append(struct.pack("<BQ", width, len(values)))
            body.append(_pack(values & np.uint32((1 << width) - 1), width))
            if k < len(widths) - 1:
                values = values >> np.uint32(width)
                more = values > 0
                body.append(np.packbits(more, bitorder="little").tobytes())
                ones = np.add.reduceat(np.append(more, 0), np.arange(0, len(more) + 1, BLOCK), dtype="<u4")
                body.append((np.cumsum(ones, dtype="<u4") - ones).astype("<u4").tobytes())
                values = values[more]
        return b"".join([MAGIC, bytes([len(widths)]), *heads, *body])

    def decode(self) -> np.ndarray:
        out = np.zeros(len(self), np.uint32)
        places, shift = None, 0
        for width, n, parts in self.levels:
            chunk = _unpack(parts[0], n, width)
            if places is None:
                out[:] = chunk
                places = np.arange(n)
            else:
                out[places] |= chunk << np.uint32(shift)
            if len(parts) > 1:
                more = np.unpackbits(np.frombuffer(parts[1], np.uint8), count=n, bitorder="little")
                places = places[more.view(bool)]
            shift += width
        return out

    def get(self, i: int) -> int:
        """The number at ``i`` by addressing alone."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        out = shift = 0
        for width, _, parts in self.levels:
            first = i * width
            window = int.from_bytes(parts[0][first // 8 : (first + width + 7) // 8], "little")
            out |= ((window >> first % 8) & ((1 << width) - 1)) << shift
            if len(parts) == 1 or not parts[1][i // 8] >> i % 8 & 1:
                break
            block = i // BLOCK
            before = int.from_bytes(parts[1][block * BLOCK // 8 : i // 8 + 1], "little")
            before &= (1 << (i - block * BLOCK)) - 1
            i = struct.unpack_from("<I", parts[2], 4 * block)[0] + before.bit_count()
            shift += width
        return out


def _shards(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    enc, end = encoder(vocabulary), np.array([end_id], dtype="<u4").tobytes()
    part, seq, start, held = TaskContext.get().partitionId(), 0, 0, 0
    ids: list[int | None] = []
    lengths: list[int] = []
    coded: list[bytes] = []

    def shard() -> pa.RecordBatch:
        codes = Dac.encode(np.frombuffer(b"".join(coded), dtype="<u4"))
        row = {"part": part, "seq": seq, "start": start, "doc_ids": ids, "lengths": lengths, "codes": codes}
        schema = pa.schema(
            [("part", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
             ("lengths", pa.list_(pa.int64())), ("codes", pa.binary())]
        )
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for doc_id, coded_text in zip(batch.column(0).to_pylist(), enc.encode_all(batch.column(1)), strict=True):
            data = coded_text + end
            ids.append(doc_id)
            lengths.append(len(data) // 4)
            coded.append(data)
            held += lengths[-1]
            if held >= shard_tokens:
                yield shard()
                seq, start, held = seq + 1, start + held, 0
                ids, lengths, coded = [], [], []
    if ids:
        yield shard()


def write_tokens(
    docs: DataFrame, path: str, end_id: int = 2, vocabulary: str | None = None, id_col: str = "doc_id",
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Write the ids of all texts to the table ``path``, in ascending id order. One
    shuffle of the texts; ids leave a task only inside of shards."""
    vocabulary = vocabulary or default_path()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    shards = ordered.mapInArrow(lambda x: _shards(x, vocabulary, end_id, shard_tokens), SHARD_SCHEMA)
    shards.write.option("compression", "none").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = Dac(row["codes"]).decode().astype("<u4")
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * len(ends), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["start"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array([ids[i:j].tobytes() for i, j in zip(starts, ends, strict=True)], pa.binary()),
                ],
                names=["part", "doc_id", "start", "n_tokens", "ids"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens and ids (little-endian
    unsigned 32-bit integers) of each document of a written table."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    # A row for each task of the writer: small enough for one window and to broadcast.
    ends = shards.groupBy("part").agg(
        F.max(F.col("start") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")
    )
    base = ends.select(
        "part", F.expr("coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)").alias("base")
    )
    docs = shards.mapInArrow(_documents, "part int, doc_id long, start long, n_tokens long, ids binary")
    return docs.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids"
    )
