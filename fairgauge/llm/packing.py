"""Sum-of-squares packing of documents into sequences (operator 3).

Texts are encoded whole; only documents longer than a sequence are cut, the first piece
taking what the full ones leave. Full pieces are sequences of their own. The others are
dealt by hash to groups of about ``GROUP_PIECES`` pieces, so no group grows with the
input, and each group is packed, longest pieces first: with N(g) open sequences of g
free places, a piece goes to the open sequence for which the sum of N(g)^2 over
0 < g < capacity becomes smallest, ties to the smallest gap left; a new sequence is
opened only where none has room, since fewest sequences are asked for.

Defined cases: a null text counts as empty and is the end id alone; repeated rows are
packed as often as they occur; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairgauge.llm.common import materialise
from fairgauge.llm.tokens import default_path, encoder

CAPACITY = 1024
#: Pieces that one task packs; each group leaves a few sequences partly empty.
GROUP_PIECES = 50_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((i, capacity) for i in range(first, n, capacity))]


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    enc, end = encoder(vocabulary), np.array([end_id], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = pa.schema([(n, pa.int32() if n == "piece" else pa.int64()) for n in names])
    for batch in batches:
        out: list[tuple] = []
        for key, ids in zip(batch.column(0).to_pylist(), enc.encode_all(batch.column(1)), strict=True):
            data = ids + end
            for k, (i, n) in enumerate(cut(len(data) // 4, capacity)):
                out.append((key, k, i, n, zlib.crc32(data[4 * i : 4 * (i + n)])))
        columns = [pa.array(c, schema.field(j).type) for j, c in enumerate(zip(*out, strict=True))] if out else None
        if columns:
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, in the order given."""
    open_at = np.zeros(capacity + 1, np.int64)  # N(g); N(0) and N(capacity) stay 0
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n_sequences, never = 0, np.iinfo(np.int64).max
    for k, s in enumerate(lengths.tolist()):
        if s >= capacity:
            sequence[k], offset[k] = n_sequences, 0
            n_sequences += 1
            continue
        # Growth of the sum of squares from gap g to g - s, for g = s ... capacity - 1;
        # the exact fit leaves no gap.
        here = open_at[s:capacity]
        growth = 2 * (open_at[: capacity - s] - here) + 2
        growth[0] = 1 - 2 * here[0]
        growth[here == 0] = never
        best = int(growth.argmin())
        if here[best]:
            gap = s + best
            bin_ = stacks[gap].pop()
            open_at[gap] -= 1
        else:
            gap, bin_ = capacity, n_sequences
            n_sequences += 1
        sequence[k], offset[k] = bin_, capacity - gap
        if gap > s:
            stacks[gap - s].append(bin_)
            open_at[gap - s] += 1
    return sequence, offset


def _pack_group(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    group = group.sort_values(["length", "doc_id", "ids_crc32"], ascending=[False, True, True], kind="stable")
    sequence, offset = sum_of_squares(group["length"].to_numpy(), capacity)
    out = group.drop(columns="pack_group")
    out["sequence_id"] = (int(group["pack_group"].iloc[0]) << 32) + sequence
    out["offset"] = offset
    return out


def pack(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = 2, vocabulary: str | None = None, id_col: str = "doc_id",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """A row per piece: its place in its document, its checksum, its sequence and its
    place there. The texts aren't shuffled; a row of six numbers per piece is."""
    vocabulary = vocabulary or default_path()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), "text")
    pieces = materialise(rows.mapInArrow(lambda x: _pieces(x, vocabulary, end_id, capacity), PIECE_SCHEMA), "pieces")
    full = pieces.where(F.col("length") >= capacity)
    parts = pieces.where(F.col("length") < capacity)
    groups = max(1, math.ceil(parts.count() / group_pieces))
    dealt = parts.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "ids_crc32"), F.lit(groups)))
    packed = dealt.groupBy("pack_group").applyInPandas(lambda g: _pack_group(g, capacity), PACKED_SCHEMA)
    alone = full.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)
