"""Words of many texts at once, as numbers: numpy over the bytes of an Arrow batch.

A word is a run without ASCII white space; A-Z are lower-cased before hashing. A word's
hash is a polynomial of its bytes (random value per byte, powers of an odd base) modulo
2**64, read off a running sum and mixed afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from fairgauge.llm import tokens

_rng = np.random.default_rng(20240229)
BYTE_VALUE = _rng.integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C13
INVERSE = pow(BASE, -1, 2**64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text that are held at once; a longer text is held alone.
CHUNK_BYTES = 1 << 19
#: Length up to which powers are kept between chunks.
KEPT_POWERS = 1 << 20

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(n, base, np.uint64)
        have[:1] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= KEPT_POWERS:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of ``n_docs`` texts in order. ``first[d] : first[d + 1]`` are those of
    text d; ``data`` are all bytes as they were."""

    n_docs: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    sums: np.ndarray

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first ``n`` bytes of the longer words, and which those are."""
        longer = np.flatnonzero(self.ends - self.starts > n)
        at = self.starts[longer]
        return mix((self.sums[at + n] - self.sums[at]) * _power(INVERSE, len(self.data))[at] + np.uint64(n)), longer

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.first))


def words_of(texts: list[bytes], separators: np.ndarray = SPACE, folded: np.ndarray = LOWER) -> Words:
    """``separators``: bytes that end a word (space among them); ``folded``: the byte
    that each byte is hashed as."""
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    inside = ~separators[data]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = turns[0::2], turns[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[folded[data]] * _power(BASE, len(data)), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _power(INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    bounds = np.concatenate([[1], 1 + np.cumsum(lengths)])
    return Words(len(texts), data, starts, ends, hashes, np.searchsorted(starts, bounds), sums)


def chunks(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with a bounded number of bytes, and their texts (null: empty)."""
    tokens.release()  # a worker that has packed texts before needn't hold its pieces
    column = batch.column(text)
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    begin, size, texts = 0, 0, []
    for i in range(batch.num_rows):
        value = column[i].as_py() or b""
        if texts and size + len(value) > CHUNK_BYTES:
            yield batch.slice(begin, i - begin), texts
            begin, size, texts = i, 0, []
        texts.append(value)
        size += len(value)
    if texts:
        yield batch.slice(begin), texts
