"""Piecewise encoding against the library's own on whole texts."""

import random

import pyarrow as pa
import pytest
from fairgauge.llm import tokens
from fairgauge.llm.tokens import Encoder, default_path


@pytest.fixture(scope="module")
def enc():
    return Encoder(default_path())


EDGES = ["", None, " ", "  ", "   ", "a  b", "a   b", " a", "  a", "   a", "a ", "a  ", "a   ", "a\nb", "a\n\nb", "a \nb", "a\n b",
         "a\t b", "a \tb", "a\t \tb", "\n", "\na", "a\n", " \n ", "it's we'll 's", "a b", "a  b", "x　 y", "né\nÉà",
         "<|endoftext|> a<|endoftext|>b", "12 34a 5,6", "日本語 テキスト", "\x00 \x01", "a \r\n b", "👍🏽 a👍", "  a", "a \x1c b"]


@pytest.mark.parametrize("text", EDGES)
def test_edges(enc, text):
    assert enc.encode(text) == enc.whole(text or "")


def test_random_texts(enc):
    rnd = random.Random(5)
    parts = ["a", "Bc", "déf", " ", " ", " ", "\n", "\t", "  ", ".", ",", "'s", "a,", "Bc.", "!", "1", "23", " ", "!!", "ß", "日", "\r\n"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(14)))
        assert enc.encode(text) == enc.whole(text), repr(text)


def test_long_text(enc):
    text = ("word " * 30_000) + "x" * 100_000
    assert enc.encode(text) == enc.whole(text)


class Counting:
    """The library's tokenizer, and the characters it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, texts, add_special_tokens):
        self.given += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    def encode(self, text, add_special_tokens):
        self.given += len(text)
        return self.tokenizer.encode(text, add_special_tokens=add_special_tokens)


def test_a_piece_of_several_texts_is_encoded_once(enc):
    fresh = Encoder(default_path())
    fresh.tokenizer = Counting(fresh.tokenizer)
    texts = [f"x{k} common words, of.\nEvery text here" for k in range(200)] + [None, "", " ", "two  spaces"]
    assert list(fresh.encode_all(pa.array(texts))) == [enc.whole(t or "") for t in texts]
    assert fresh.tokenizer.given < 1500
    assert list(fresh.encode_all(pa.array([], pa.string()))) == []
    assert list(fresh.encode_all(pa.array(texts, pa.large_string())[3:7])) == [enc.whole(t) for t in texts[3:7]]


def test_kept_pieces_are_bounded(enc, monkeypatch):
    """Pieces that didn't appear again go first; what goes is encoded anew."""
    monkeypatch.setattr(tokens, "KEPT_PIECES", 40)
    monkeypatch.setattr(tokens, "KEPT_LINES", 10)
    monkeypatch.setattr(tokens, "TOGETHER", 100)
    fresh, rnd = Encoder(default_path()), random.Random(3)
    often = [f"often{k}" for k in range(5)]
    texts = [" ".join([*often, *(f"w{rnd.randrange(300)}{rnd.choice(['', ',', chr(10) + 'b'])}" for _ in range(9))]) for _ in range(300)]
    assert list(fresh.encode_all(pa.array(texts))) == [enc.whole(t) for t in texts]
    assert len(fresh.kept) <= 40 and len(fresh.bare) <= 30
    assert set(often[1:]) <= set(fresh.kept.to_pylist())


def test_places_of_pieces_among_the_kept():
    import pyarrow as pa
    from fairgauge.llm.tokens import _places

    kept, none = pa.array(["b", "", "a", "ä"]), pa.array([], pa.string())
    assert _places(pa.array(["a", "c", "b", ""]), kept).tolist() == [2, -1, 0, 1]
    assert _places(none, kept).tolist() == [] and _places(kept, none).tolist() == [-1] * 4


def test_white_space_marks_and_lines_leave_no_piece_to_encode_twice(enc):
    """Runs of white space, line breaks and marks between the same words add no new piece."""
    fresh, rnd = Encoder(default_path()), random.Random(7)
    fresh.tokenizer = Counting(fresh.tokenizer)
    words = [f"{a}{b}" for a in ("red", "grün", "日本") for b in ("der", "ware", "s")]
    gaps = [" ", "  ", "\n", "\n\n", "\r\n", "\t", ". ", ", ", ".\n", "-"]
    texts = ["".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(40)) for _ in range(300)]
    assert list(fresh.encode_all(pa.array(texts))) == [enc.whole(t) for t in texts]
    assert fresh.tokenizer.given < 2000


def test_random_white_space_of_any_script(enc):
    """In Arrow slices of several texts, so that a cut beside a text's end is seen."""
    rnd = random.Random(11)
    white = [chr(c) for c in (9, 10, 11, 12, 13, 0x1C, 0x1F, 32, 0x85, 0xA0, 0x1680, 0x180E, 0x200A, 0x200B, 0x2028, 0x202F, 0x205F, 0x3000)]
    parts = [*white, " ", " ", "\n", "\n", "a", "Bc", "é", "日", "1", ".", ",", "'s", "'", "(", "“", "”", "\x00"]
    texts = [None if rnd.random() < 0.05 else "".join(rnd.choice(parts) for _ in range(rnd.randrange(12))) for _ in range(6000)]
    got = list(enc.encode_all(pa.array(texts).slice(3)))
    assert got == [enc.whole(t or "") for t in texts[3:]]
