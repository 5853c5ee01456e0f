"""Reply parsing, PA-1 … PA-5.

Two dialects, as in the scoring scripts. The strict form needs one contiguous
row with a closing pipe; the lenient form joins cells over anything between
them, so with two score rows F comes from the first, A/I/R from the last.

Both scripts search with patterns that backtrack (to the fourth power of the
number of cells in the lenient form, to the third of a run of spaces in both).
Here a reply is scanned once, by a pattern whose quantifiers never give back, and
what the backtracking would settle on is picked from the list of cells:

* the name starts behind the reply's first pipe, and F is the first F cell whose
  own pipe is a later one;
* lenient: R is the last R cell, I the last I cell before it, A the last A cell
  before that, and all follow F;
* strict: the first contiguous row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairgauge.functions import patterns as P
from fairgauge.functions.text import ascii_digits, let, strip

SCORE_COLUMNS = ("f_score", "a_score", "i_score", "r_score")


def _struct(ok: Column, name: Column, scores: list[Column]) -> Column:
    """PA-3 … PA-5. A digit run beyond BIGINT becomes NULL (and invalid)."""
    values = [F.when(ok, ascii_digits(s).try_cast("bigint")).alias(n) for n, s in zip(SCORE_COLUMNS, scores, strict=True)]
    return F.struct(F.coalesce(ok, F.lit(False)).alias("parse_ok"), F.when(ok, strip(name)).alias("parsed_dataset_name"), *values)


def _before(text: Column, part: Column) -> Column:
    """What stands before the first ``part``."""
    return F.call_function("substring_index", text, part, F.lit(1))


def _behind_first_pipe(reply: Column) -> Column:
    at = F.instr(reply, "|")
    return F.when(at > 0, F.substring(reply, at + 1, F.length(reply)))


def strict(reply: Column) -> Column:
    """PA-1 (dialect A)."""

    def parsed(tail: Column) -> Column:
        def of(row: Column) -> Column:
            scores = [F.regexp_extract(row, P.STRICT_ROW_RE, i) for i in range(1, 5)]
            return _struct(row != "", _before(tail, row), scores)

        return let(F.regexp_extract(tail, P.STRICT_ROW_RE, 0), of)

    return let(_behind_first_pipe(reply), parsed)


def _last(kinds: Column, kind: str) -> Column:
    """Place (from 1) of the last ``kind``, 0 if none."""
    back = F.instr(F.reverse(kinds), kind)
    return F.when(back > 0, F.length(kinds) - back + 1).otherwise(0)


def lenient(reply: Column) -> Column:
    """PA-2 (dialect B)."""

    def parsed(tail: Column) -> Column:
        cells = F.regexp_extract_all(tail, F.lit(P.SCORE_CELLS_RE), 0)
        numbered = F.transform(
            cells,
            lambda c: F.struct(
                F.regexp_extract(c, "([FAIR])-Score", 1).alias("kind"), F.regexp_extract(c, r"\((\p{Nd}+)/", 1).alias("score"), c.alias("cell")
            ),
        )

        def of(all_cells: Column) -> Column:
            kinds = F.array_join(F.transform(all_cells, lambda c: c["kind"]), "")

            def picked(k: Column) -> Column:
                f, r = F.instr(k, "F"), _last(k, "R")
                return let(F.struct(k.alias("k"), f.alias("f"), r.alias("r")), lambda s: let(
                    F.struct(s["f"].alias("f"), s["r"].alias("r"), _last(F.substring(s["k"], F.lit(1), s["r"] - 1), "I").alias("i"), s["k"].alias("k")),
                    lambda s: let(
                        F.struct(s["f"].alias("f"), s["r"].alias("r"), s["i"].alias("i"), _last(F.substring(s["k"], F.lit(1), s["i"] - 1), "A").alias("a")),
                        lambda s: _struct(
                            (s["f"] > 0) & (s["a"] > s["f"]),
                            _before(tail, F.get(all_cells, s["f"] - 1)["cell"]),
                            [F.get(all_cells, s[x] - 1)["score"] for x in "fair"],
                        ),
                    ),
                ))

            return let(kinds, picked)

        return let(numbered, of)

    return let(_behind_first_pipe(reply), parsed)


def with_parsed(df: DataFrame, reply: str = "response", dialect: str = "dialect") -> DataFrame:
    """Add ``parse_ok, parsed_dataset_name, f/a/i/r_score`` by each row's
    ``dialect``; a row of no known dialect stays unparsed (``parse_ok`` NULL)
    and flagged by that.

    The fields leave through a Generate, so that a filter on them isn't pushed
    below it, where it would repeat the parsing.
    """
    r, d = F.col(reply), F.col(dialect)
    return _generated(df, F.when(d == "A", strict(r)).when(d == "B", lenient(r)))


def parsed_as(df: DataFrame, dialect: str, reply: str = "response") -> DataFrame:
    """The same for replies of one dialect."""
    return _generated(df, (strict if dialect == "A" else lenient)(F.col(reply)))


def _generated(df: DataFrame, parsed: Column) -> DataFrame:
    return df.select("*", F.inline(F.array(parsed)))


def multi_row_reply(reply: Column) -> Column:
    """More than one F-score cell: the lenient parse may mix rows."""
    return F.coalesce(F.size(F.regexp_extract_all(reply, F.lit(P.SCORE_CELL_RE["f"]), 0)) > 1, F.lit(False))
