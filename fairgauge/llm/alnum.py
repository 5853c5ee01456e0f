"""Words of letters and digits over the bytes of many texts, in pieces of bounded size.

A word is a run of ``0-9 A-Z a-z`` and bytes above 0x7F; every other byte separates. A-Z
count as a-z. As all bytes of a non-ASCII character belong to words, texts are cut and
compared as UTF-8 bytes.

A text longer than a piece is worked through piece by piece: a cut stands behind a word,
and the next piece repeats the last ``carried`` words, so that every run of up to
``carried`` + 1 words lies whole in a piece. Only a single word is ever held longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Each byte as it counts: letters lower-cased, every separator a space.
FOLDED = np.full(256, 0x20, np.uint8)
FOLDED[0x30:0x3A] = np.arange(0x30, 0x3A)
FOLDED[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLDED[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLDED[0x80:] = np.arange(0x80, 0x100)
SPACE = 0x20
#: Bytes of text worked on at once.
PIECE_BYTES = 1 << 19


@dataclass
class Block:
    """Words of several pieces: word k is ``data[starts[k] : ends[k]]``. Piece p belongs to
    input row ``rows[p]``; its words are ``first[p] : first[p + 1]``, the leading
    ``carried[p]`` of which its row's piece before has, too; ``last[p]``: it ends its row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    carried: np.ndarray
    last: np.ndarray

    @property
    def piece(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows)), np.diff(self.first))


def _turns(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of folded bytes that begin and end with a space."""
    inside = data != SPACE
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return turns[0::2], turns[1::2]


def _word_end(text: np.ndarray, at: int) -> int:
    """The next place from ``at`` on where no word stands."""
    while at < len(text):
        outside = FOLDED[text[at : at + 4096]] == SPACE
        k = int(outside.argmax())
        if outside[k]:
            return at + k
        at += len(outside)
    return len(text)


def _pieces(text: bytes, size: int, overlap: int) -> Iterator[tuple[bytes, int, bool]]:
    """(bytes, words of them carried, whether the text ends) of a text's pieces."""
    if len(text) <= size:
        yield text, 0, True
        return
    view = np.frombuffer(text, np.uint8)
    begin = at = carried = 0
    while True:
        end = _word_end(view, at + size)
        yield text[begin:end], carried, end >= len(text)
        if end >= len(text):
            return
        at, before, begin, carried = end, begin, end, 0
        reach = 64 * overlap
        while overlap:  # the last words, which mostly are short
            low = max(before, end - reach)
            starts, _ = _turns(np.concatenate([[SPACE], FOLDED[view[low:end]], [SPACE]]).astype(np.uint8))
            if low == before or len(starts) > overlap:
                starts = starts[-overlap:]
                begin, carried = (low + int(starts[0]) - 1, len(starts)) if len(starts) else (end, 0)
                break
            reach *= 4


def _block(parts: list[tuple[int, bytes, int, bool]]) -> Block:
    raw = b" " + b" ".join(p[1] for p in parts) + b" "
    data = FOLDED[np.frombuffer(raw, np.uint8)]
    starts, ends = _turns(data)
    bounds = np.cumsum([1, *(len(p[1]) + 1 for p in parts)])
    rows, carried = np.array([p[0] for p in parts]), np.array([p[2] for p in parts])
    return Block(data, starts, ends, rows, np.searchsorted(starts, bounds), carried, np.array([p[3] for p in parts]))


def blocks(texts: pa.Array, overlap: int = 0, size: int = PIECE_BYTES) -> Iterator[Block]:
    """All texts of a column (null: empty), in order, in blocks of about ``size`` bytes."""
    held: list[tuple[int, bytes, int, bool]] = []
    total = 0
    for row, value in enumerate(texts):
        text = value.as_py() or b""
        if isinstance(text, str):
            text = text.encode()
        for piece, carried, last in _pieces(text, size, overlap):
            if held and total + len(piece) > size:
                yield _block(held)
                held, total = [], 0
            held.append((row, piece, carried, last))
            total += len(piece)
    if held:
        yield _block(held)


def equal_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a uint8 matrix: one place of each different row, and the number of its row among
    those for each row. Rows are compared whole, eight bytes at a time."""
    n, width = matrix.shape
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = matrix
    keys = padded.view(np.uint64)
    order = np.argsort(keys[:, 0], kind="stable") if keys.shape[1] == 1 else np.lexsort(keys.T)
    ordered = keys[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
    inverse = np.empty(n, np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order[new], inverse
