"""Token ids of whole texts, by the tokenizers library.

Byte-level BPE encodes each pre-token on its own, so a text may be cut wherever a
pre-token is sure to begin, and the ids of a cut kept for its next appearance:

* before a space, tab or line break, unless white space stands on both of its sides (a run
  of white space is one pre-token, but for its last character where text follows);
* after a tab or line break, before a character that isn't white space;
* between an ASCII letter and an ASCII mark.

The cuts are found on the octets of many texts at once and the distinct pieces by Arrow.
The library encodes those that aren't kept, many in a call; ``test_tokens.py`` holds the
result against the library's own on whole texts.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces whose ids a worker keeps, and the length in bytes of the longest kept. Past that
#: number those go that did not appear again since the last time.
KEPT_PIECES = 300_000
KEPT_LENGTH = 48
#: Lines whose ids a worker keeps.
KEPT_LINES = 50_000
#: Bytes of texts that are encoded together.
TOGETHER = 1 << 21
#: Pieces that the library encodes in one call.
IN_A_CALL = 512
#: What an octet may be.
LETTER, MARK, SPACE, BREAK, WHITE = 1, 2, 4, 8, 16
KINDS = np.zeros(256, np.uint8)
for _kind, _octets in (
    (LETTER, string.ascii_letters.encode()), (MARK, string.punctuation.encode()), (SPACE, b" "), (BREAK, b"\t\n\r"),
    (WHITE, b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "),
):
    KINDS[list(_octets)] |= _kind
#: White space outside of ASCII, in UTF-8 (U+180E is, in older Unicode).
WIDE_WHITE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _places(pieces: pa.Array, kept: pa.Array) -> np.ndarray:
    """Where each of some different pieces stands among the kept, -1 if nowhere. The few
    are hashed and the many looked up, as a look-up costs less than an entry."""
    found = pc.index_in(kept, value_set=pieces)
    hit = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
    out = np.full(len(pieces), -1, np.int64)
    out[found.drop_null().to_numpy()] = hit
    return out


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each octet of UTF-8. White space is all that the library or Python counts as such."""
    kinds = KINDS[data]
    for lead in {x[0] for x in WIDE_WHITE}:
        at = np.flatnonzero(data == lead)
        for x in WIDE_WHITE if len(at) else ():
            if x[0] == lead:
                hit = at[data[at + 1] == x[1]]
                hit = hit[data[hit + 2] == x[2]] if len(x) == 3 else hit
                for k in range(len(x)):
                    kinds[hit + k] = WHITE
    return kinds


def _cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts that stand one after another. ``bounds``: each text's
    first octet, and the end."""
    kinds = _kinds(data)
    solid = (kinds & WHITE) == 0
    ends = bounds[1:][np.diff(bounds) > 0]
    follows = np.append(solid[1:], False)
    follows[ends - 1] = False
    cut = (kinds & (SPACE | BREAK)) != 0
    cut[1:] &= solid[:-1] | follows[1:]
    cut[1:] |= ((kinds[:-1] & BREAK) != 0) & solid[1:]
    cut[1:] |= ((kinds[:-1] & LETTER) != 0) & ((kinds[1:] & MARK) != 0)
    cut[bounds[bounds < len(data)]] = True
    return np.flatnonzero(cut)


def _octets(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The octets of strings without nulls, and where each begins and the last ends."""
    if not len(strings):
        return np.zeros(0, np.uint8), np.zeros(1, np.int32)
    bounds = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data))


class Encoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit bytes. Strings
    of special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        #: " " + piece: the pieces, their ids and which of them appeared again.
        self.kept = pa.array([], pa.string())
        self.kept_ids = pa.array([], pa.large_binary())
        self.again = np.zeros(0, bool)
        #: Pieces that don't begin with a space.
        self.bare: dict[str, bytes] = {}
        #: Which ids begin with a space, as the first of every spaced word does.
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.feed = np.frombuffer(self.whole("\n"), "<u4")[0]

    def whole(self, text: str) -> bytes:
        """By the library; the "fast" call leaves out the offsets alone."""
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype="<u4").tobytes()

    def _keep(self, pieces: pa.Array, ids: pa.Array) -> None:
        short = pc.less_equal(pc.binary_length(pieces), KEPT_LENGTH)
        self.kept = pa.concat_arrays([self.kept, pieces.filter(short)])
        self.kept_ids = pa.concat_arrays([self.kept_ids, ids.filter(short)])
        self.again = np.append(self.again, np.zeros(len(self.kept) - len(self.again), bool))
        if len(self.kept) > KEPT_PIECES:
            stay = np.flatnonzero(self.again)[-KEPT_PIECES // 2 :]
            self.kept, self.kept_ids = self.kept.take(pa.array(stay)), self.kept_ids.take(pa.array(stay))
            self.again = np.zeros(len(stay), bool)

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of " " + word for words that are not kept. Those without white space at their
        ends are encoded together: each begins a pre-token with its space, and no other id
        begins with one."""
        data, bounds = _octets(words)
        solid = np.append((_kinds(data) & WHITE) == 0, False)
        plain = solid[bounds[:-1]] & solid[bounds[1:] - 1] & (np.diff(bounds) > 0)
        plain &= ~pc.match_substring(words, " ").to_numpy(zero_copy_only=False)
        odd = [self.whole(" " + word) for word in words.filter(pa.array(~plain)).to_pylist()]
        coded, lengths = [], []
        together = words.filter(pa.array(plain)).to_pylist()
        for k in range(0, len(together), IN_A_CALL):
            some = together[k : k + IN_A_CALL]
            ids = self.whole(" " + " ".join(some))
            starts = np.flatnonzero(self.begins[np.frombuffer(ids, "<u4")])
            if len(starts) == len(some):
                coded.append(ids)
                lengths.append(4 * np.diff(starts, append=len(ids) // 4))
            else:
                each = [self.whole(" " + word) for word in some]
                coded += each
                lengths.append(np.array([len(x) for x in each]))
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *lengths]), dtype=np.int64)
        known = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(together), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(coded))])
        if not odd:
            return known
        where = np.where(plain, np.cumsum(plain) - 1, len(together) + np.cumsum(~plain) - 1)
        return pa.concat_arrays([known, pa.array(odd, pa.large_binary())]).take(pa.array(where))

    def _lines(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces that don't begin with a space. New ones without white space
        at their ends are encoded together, in lines: a line feed between characters that
        aren't white space is a pre-token of its own."""
        found = {piece: self.bare.get(piece) for piece in pieces}
        new = [piece for piece, ids in found.items() if ids is None]
        together = [x for x in new if "\n" not in x and not x[0].isspace() and not x[-1].isspace()]
        for k in range(0, len(together), IN_A_CALL):
            some = together[k : k + IN_A_CALL]
            data = self.whole("\n".join(some))
            parts = np.frombuffer(data, "<u4")
            feeds = np.flatnonzero(parts == self.feed).tolist()
            if len(feeds) == len(some) - 1:
                ends = [*feeds, len(parts)]
                found.update((x, data[4 * i : 4 * j]) for x, i, j in zip(some, [0, *(f + 1 for f in feeds)], ends, strict=True))
        for piece in new:
            if found[piece] is None:
                found[piece] = self.whole(piece)
        if len(self.bare) + len(new) > KEPT_LINES:
            self.bare.clear()
        self.bare.update((x, found[x]) for x in new[:KEPT_LINES] if len(x) <= KEPT_LENGTH)
        return list(found.values())

    def _ids(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces, none of them empty."""
        data, bounds = _octets(pieces)
        is_word = data[bounds[:-1]] == ord(" ")
        data, bounds = _octets(pieces.filter(pa.array(is_word)))
        words = _strings(np.delete(data, bounds[:-1]), bounds - np.arange(len(bounds)))
        at_kept = _places(words, self.kept)
        is_new = at_kept < 0
        self.again[at_kept[~is_new]] = True
        new = words.filter(pa.array(is_new))
        new_ids = self._words(new)
        lines = self._lines(pieces.filter(pa.array(~is_word)).to_pylist())
        known = pa.concat_arrays([self.kept_ids, new_ids, pa.array(lines, pa.large_binary())])
        at_kept[is_new] = len(self.kept) + np.arange(len(new))
        where = np.empty(len(pieces), np.int64)
        where[is_word] = at_kept
        where[~is_word] = len(known) - len(lines) + np.arange(len(lines))
        self._keep(new, new_ids)
        return known.take(pa.array(where))

    def encode(self, text: str | None) -> bytes:
        return self._together(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text. Texts of about ``TOGETHER`` bytes are encoded together."""
        upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(texts):
            held = int(upto[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(upto, held + TOGETHER)))
            yield from self._together(texts.slice(start, end - start))
            start = end
        pa.default_memory_pool().release_unused()  # else a worker holds 140 MB more

    def _together(self, texts: pa.Array) -> list[bytes]:
        """Arrow finds the texts' distinct pieces; only those are looked up."""
        data, bounds = _octets(pc.fill_null(texts.cast(pa.string()), ""))
        places = _cuts(data, bounds)
        if not len(places):
            return [b""] * len(texts)
        coded = _strings(data, np.append(places, len(data))).dictionary_encode()
        ids = self._ids(coded.dictionary).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[np.searchsorted(places, bounds)].tolist()
        body = memoryview(ids.buffers()[2])
        return [bytes(body[i:j]) for i, j in zip(ends, ends[1:], strict=False)]


def release() -> None:
    """Let go of a worker's encoders: its next tasks are of another kind."""
    encoder.cache_clear()


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Encoder(path)
