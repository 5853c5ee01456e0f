"""Scalar text helpers as Spark column expressions (FN-1, FN-2, FN-6, FN-9, FN-11).

All of it runs on the JVM: character references are decoded by a single
pass over the text split at '&' (no Python, no regex callbacks).
"""

from __future__ import annotations

import html
import html.entities
import json
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from fairgauge.functions.patterns import PY_WHITESPACE

# ---------------------------------------------------------------------------
# The most frequent named references, looked up first in a
# short table (values from the HTML standard). The oracle decodes these and
# the Latin-1 names with a chain of replace() calls, '&amp;' last.
# ---------------------------------------------------------------------------
JVM_ENTITY_NAMES = [
    "lt", "gt", "quot", "apos", "nbsp", "copy", "reg", "trade", "middot",
    "hellip", "mdash", "ndash", "lsquo", "rsquo", "ldquo", "rdquo",
    "laquo", "raquo", "bull", "#39", "#34", "#160", "#8217", "#8220",
    "#8221", "#8211", "#8212", "#x27", "amp",
]


def _ref_value(name: str) -> str:
    return html.unescape("&" + name + ";")


JVM_ENTITIES = [("&" + n + ";", _ref_value(n)) for n in JVM_ENTITY_NAMES]

#: Every ';'-terminated named reference of the HTML standard (the stdlib's
#: table), name without '&' and ';' -> text.
NAMED_REFS = {k[:-1]: v for k, v in html.entities.html5.items() if k.endswith(";")}
# Short table looked up first: the names above plus the Latin-1 letters and
# signs (code points 160-255, the stdlib's names for them), frequent in
# European pages. A map literal is searched linearly, so the long table is
# reached only for rare names.
_COMMON = {n: _ref_value(n) for n in JVM_ENTITY_NAMES if not n.startswith("#")}
_COMMON.update({html.entities.codepoint2name[cp]: chr(cp) for cp in range(160, 256)})
#: Names that also count without their ';' (the stdlib's table lists them so),
#: longest first: of several that fit, the longest one is read.
LEGACY_NAMES = sorted((k for k in html.entities.html5 if not k.endswith(";")), key=lambda k: (-len(k), k))
_COMMON.update({n: html.entities.html5[n] for n in LEGACY_NAMES})


def _special_code_points() -> dict[int, str]:
    """Numeric references that do not decode to their own code point (NUL,
    C0/C1 controls, noncharacters), by the stdlib's rule for them."""
    cps = list(range(0x00, 0x20)) + list(range(0x7F, 0xA0)) + list(range(0xFDD0, 0xFDF0))
    cps += [plane * 0x10000 + low for plane in range(0x11) for low in (0xFFFE, 0xFFFF)]
    out = {}
    for cp in cps:
        text = html.unescape(f"&#{cp};")
        if text != chr(cp):
            out[cp] = text
    return out


SPECIAL_CODE_POINTS = _special_code_points()


# Each table is one JSON string literal read by from_json: constant folding
# turns it into a map literal once, instead of analysing a map() call with
# hundreds of arguments in every plan. Map literals are searched linearly, so
# the full table's names are grouped by first letter: two short searches.
_BY_LETTER: dict[str, dict[str, str]] = {}
for _name, _text in NAMED_REFS.items():
    _BY_LETTER.setdefault(_name[0], {})[_name] = _text
_NAMED_JSON = json.dumps(_BY_LETTER)
_COMMON_JSON = json.dumps(_COMMON)
_SPECIAL_JSON = json.dumps({str(k): v for k, v in SPECIAL_CODE_POINTS.items()})

#: A reference at the start of the text that follows an '&': a number, with or
#: without ';', or a name up to its ';'.
REF_HEAD_RE = "^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*;)"
LEGACY_RE = "^(" + "|".join(LEGACY_NAMES) + ")"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once. Inside higher-order
    function lambdas Spark evaluates every occurrence of an expression again;
    a one-element ``transform`` binds it to a variable instead."""
    return F.transform(F.array(value), body)[0]


def _code_point_text(num: Column) -> Column:
    special = F.from_json(F.lit(_SPECIAL_JSON), "map<string,string>")
    return (
        F.when((num > 0x10FFFF) | num.between(0xD800, 0xDFFF), F.lit("\ufffd"))
        .otherwise(F.coalesce(special[num.cast("string")], F.format_string("%c", num.cast("int"))))
    )


def _numeric_value(name: Column) -> Column:
    """Text of '&#...;' by the HTML standard's rules (as html.unescape)."""
    hexa = name.rlike("^#[xX]")
    digits = F.regexp_replace(name, "^#[xX]?0*+", "")
    # More than 6 hex or 7 decimal digits (leading zeros dropped) is past
    # U+10FFFF; the sentinel keeps such runs out of the casts.
    num = F.when(F.length(digits) > F.when(hexa, F.lit(6)).otherwise(F.lit(7)), F.lit(0x110000)).otherwise(
        F.coalesce(F.when(hexa, F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint"), F.lit(0))
    )
    return let(num, _code_point_text)


def _named_value(name: Column) -> Column:
    """Text of '&name;', NULL for an unknown name. Each map literal is
    searched once (a missing key gives NULL); the long one only on a miss."""
    common = F.from_json(F.lit(_COMMON_JSON), "map<string,string>")
    named = F.from_json(F.lit(_NAMED_JSON), "map<string,map<string,string>>")
    return F.coalesce(common[name], named[F.substring(name, 1, 1)][name])


def _decode_piece(piece: Column, name: Column, i: Column) -> Column:
    """One piece of the text split at '&': the first piece is plain text;
    any other starts right after an '&' and begins with a reference (``name``,
    '' if none) or not.

    Lambda bodies are evaluated without common-subexpression elimination, so
    the reference's value appears once: ``concat`` is NULL when the value is,
    and ``coalesce`` then keeps the '&' and the piece as they were.
    """
    number = name.startswith("#")
    value = F.when(number, _numeric_value(name)).when(name != "", _named_value(F.substring(name, F.lit(1), F.length(name) - 1)))
    read = F.length(name) + F.when(number & (F.substring(piece, F.length(name) + 1, F.lit(1)) == ";"), 1).otherwise(0)
    rest = F.substring(piece, read + 1, F.length(piece))
    legacy = let(
        F.regexp_extract(piece, LEGACY_RE, 1),
        lambda n: F.concat(F.from_json(F.lit(_COMMON_JSON), "map<string,string>")[n], F.substring(piece, F.length(n) + 1, F.length(piece))),
    )
    return F.when(i == 0, piece).otherwise(F.coalesce(F.concat(value, rest), legacy, F.concat(F.lit("&"), piece)))


def unescape(c: Column) -> Column:
    """FN-2: decode character references the way the DOM parser does, in one
    pass (decoded text is never decoded again: '&amp;lt;' gives '&lt;').

    As there, a name without ';' (or one that is unknown with it) is read as the
    longest of the legacy names it begins with: '&copy 2020', '&ampx'.
    """
    pieces = F.transform(
        F.split(c, "&"), lambda p: F.struct(p.alias("p"), F.regexp_extract(p, REF_HEAD_RE, 1).alias("n"))
    )
    decoded = F.array_join(F.transform(pieces, lambda s, i: _decode_piece(s["p"], s["n"], i)), "")
    return F.when(F.instr(c, "&") == 0, c).otherwise(decoded)


def strip(c: Column) -> Column:
    """FN-1: Python ``str.strip()`` — every Unicode space, not just U+0020."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def unquote(c: Column) -> Column:
    """Drop the quotes around an attribute value taken verbatim from a tag."""
    quoted = F.substring(c, 1, 1).isin('"', "'")
    return F.when(quoted, F.substring(c, F.lit(2), F.length(c) - 2)).otherwise(c)


#: What Python prints as an escape: controls, formats, unassigned, separators but ' '.
UNPRINTABLE_RE = r"[\p{C}\p{Z}&&[^ ]]"


def _escaped_char(c: Column) -> Column:
    cp = F.ascii(c)
    code = (
        F.when(cp < 0x100, F.format_string("\\x%02x", cp)).when(cp < 0x10000, F.format_string("\\u%04x", cp)).otherwise(F.format_string("\\U%08x", cp))
    )
    return F.when(c.rlike(UNPRINTABLE_RE), code).otherwise(c)


def py_repr_str(x: Column) -> Column:
    """Python ``repr()`` of one string: quote choice and escapes."""
    esc = F.replace(x, F.lit("\\"), F.lit("\\\\"))
    esc = F.replace(esc, F.lit("\n"), F.lit("\\n"))
    esc = F.replace(esc, F.lit("\r"), F.lit("\\r"))
    esc = F.replace(esc, F.lit("\t"), F.lit("\\t"))
    esc = F.when(esc.rlike(UNPRINTABLE_RE), F.array_join(F.transform(F.regexp_extract_all(esc, F.lit("(?s)."), 0), _escaped_char), "")).otherwise(esc)
    double = (F.instr(x, "'") > 0) & (F.instr(x, '"') == 0)
    return F.when(double, F.concat(F.lit('"'), esc, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def py_list_repr(arr: Column) -> Column:
    """FN-9: the text Python prints for a list of strings, e.g. ``['a', 'b']``."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, py_repr_str), ", "), F.lit("]"))


def fstr(c: Column) -> Column:
    """FN-11: a catalogue cell inside an f-string. Missing cells print as
    pandas' NaN does."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


#: Decimal digits beyond ASCII and their values, from the stdlib's character database.
OTHER_DIGITS = {chr(c): str(unicodedata.decimal(chr(c))) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"}


def ascii_digits(digits: Column) -> Column:
    """FN-6: digits of any script as 0-9, as Python's ``int`` reads them."""
    return F.translate(digits, "".join(OTHER_DIGITS), "".join(OTHER_DIGITS.values()))
