"""Small tables with every awkward row, shared by the operators' tests."""

from __future__ import annotations

import random

#: Names that operators use inside, as columns of the input.
CLASHES = ["id", "row", "size", "key", "node", "digest", "salt", "rank", "place", "bucket", "start", "text_hash", "norm",
           "score", "label", "target", "copies", "source_key", "position", "kept", "component_id"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def documents(spark, rows):
    """``rows``: (doc_id, text, source)."""
    full = [(i, t, None, s, None if t is None else len(t), *["x"] * len(CLASHES)) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rnd: random.Random, n: int) -> str:
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 7))) for _ in range(n))


def awkward_rows():
    rnd = random.Random(3)
    base = prose(rnd, 60)
    near = base.replace(base.split()[30], "changed", 1)
    return [
        (1, None, "a"), (2, "", None), (3, " \t\n ", "a"), (4, "One", "b"), (5, "one", "b"), (6, "ONE", None),
        (7, base, "a"), (8, near, "c"), (9, base.upper(), "a"), (9, base.upper(), "a"), (None, base, "b"), (None, None, None),
        (10, "word " * 20_000, "a"), (11, "x" * 50_000, "c"), (12, "naïve café\u00a0日本", "é"), (12, "other text of one id", "z"),
        (13, prose(rnd, 400), "a"), (14, prose(rnd, 3), "b"),
    ]
