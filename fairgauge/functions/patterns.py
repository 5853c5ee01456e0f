"""Regular expressions and fixed word lists shared by the Spark operators and
the DuckDB oracle.

Spark evaluates patterns with ``java.util.regex``; the oracle runs them on
DuckDB's RE2. Patterns that both run stay inside the subset both dialects read
the same way: no look-around, code points written ``\\x{...}``, and whitespace
classes spelled out instead of ``\\s`` (Java's ``\\s`` includes vertical tab,
RE2's does not, Python's covers all Unicode spaces). Where the engines need
different forms (possessive quantifiers, flags) the pattern has a ``*_RE2`` twin.
"""

from __future__ import annotations

import sys

# Python's ``str.isspace()`` set: what ``str.strip()`` removes and what
# ``\s`` matches in a ``str`` pattern. Derived by rule, not listed.
PY_WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())



def _ranges(chars: str) -> str:
    """Class body for a set of characters, consecutive code points merged."""
    cps = sorted(ord(c) for c in chars)
    out, start, prev = [], cps[0], cps[0]
    for cp in cps[1:] + [None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        out.append("\\x{%x}" % start if start == prev else "\\x{%x}-\\x{%x}" % (start, prev))
        if cp is not None:
            start = prev = cp
    return "".join(out)


#: Regex class equal to Python's ``\s`` for ``str`` patterns.
WS = "[" + _ranges(PY_WHITESPACE) + "]"

#: HTML's own whitespace (the tokenizer's attribute separators).
HWS = "[ \\t\\n\\f\\r]"

#: Marks a text-node boundary while HTML is flattened to text. Not in ``WS``.
NODE_SEP = "\x01"
NODE_SEP_RE = "\\x01"
#: Stands for a page's own ``NODE_SEP`` while its text is marked (a noncharacter).
HELD = "\ufdd0"

# Element content the DOM never shows as text: comments, script, style and
# template bodies. An unclosed block runs to the end of the document. The
# shared '<' is factored out so that other positions fail on one compare.
_HIDDEN = (
    r"<(?:!--.*?(?:-->|\z)"
    r"|script\b[^>]*>.*?(?:</script[ \t\n\f\r]*>|\z)"
    r"|style\b[^>]*>.*?(?:</style[ \t\n\f\r]*>|\z)"
    r"|template\b[^>]*>.*?(?:</template[ \t\n\f\r]*>|\z))"
)


def _tag(head: str, java: bool) -> str:
    """A tag whose quoted attribute values may hold '>'. As in HTML, a quote
    opens a value only behind '='; elsewhere it is an ordinary character.

    Java runs a repeated group with alternatives by recursion, one frame per
    repetition: a long unquoted attribute (an inline data URI) overflows the
    stack and kills the executor. The Java form therefore uses possessive
    quantifiers, which Java runs as a loop. RE2 has no backtracking and takes
    the plain form.
    """
    if java:
        return head + r"""(?:[^>=]++|=[ \t\n\f\r]*+"[^"]*+"|=[ \t\n\f\r]*+'[^']*+'|=)*+>"""
    return head + r"""(?:[^>=]|=[ \t\n\f\r]*"[^"]*"|=[ \t\n\f\r]*'[^']*'|=)*>"""


#: Hidden blocks: replaced by ``HIDDEN_MARK`` before tags are looked up.
HIDDEN_RE = "(?is)" + _HIDDEN
#: What a hidden block leaves behind: an empty markup declaration, so that it
#: still separates text nodes and still counts as markup inside a title.
HIDDEN_MARK = "<!>"
#: Any tag (and doctype, processing instruction, hidden-block marker); every
#: match separates two text nodes.
TAG_RE = "(?is)" + _tag("<[a-z/!?]", java=True)
TAG_RE_RE2 = "(?is)" + _tag("<[a-z/!?]", java=False)

TITLE_OPEN_RE = r"(?is)<title\b[^>]*>"
TITLE_RE = r"(?is)<title\b[^>]*>(.*?)(?:</title[ \t\n\f\r]*>|\z)"
#: Markup inside a title: the DOM gives it several children, so no string.
NESTED_MARKUP_RE = r"(?i)<[a-z/!?]"

META_TAG_RE = "(?is)" + _tag(r"<meta\b", java=True)
META_TAG_RE_RE2 = "(?is)" + _tag(r"<meta\b", java=False)
#: One attribute of a tag, read from left to right: its name, then (maybe) its
#: value. What stands inside a value is consumed with it.
ATTRIBUTE_RE = (
    r"""(?s)([^ \t\n\f\r/>=][^ \t\n\f\r/>=]*)"""
    r"""(?:[ \t\n\f\r]*=[ \t\n\f\r]*("[^"]*"|'[^']*'|[^ \t\n\f\r>"'][^ \t\n\f\r>]*))?"""
)
#: A tag's opening up to its attributes.
TAG_HEAD_RE = "(?i)^<[a-z][^ \\t\\n\\f\\r/>]*"

ANCHOR_TAG_RE = "(?is)" + _tag(r"<a[ \t\n\f\r/]", java=True)
ANCHOR_TAG_RE_RE2 = "(?is)" + _tag(r"<a[ \t\n\f\r/]", java=False)
# ---------------------------------------------------------------------------
# These must equal the scoring scripts' own constants.
# ---------------------------------------------------------------------------
LICENSE_KEYWORDS = ["license", "creativecommons", "CC-BY", "public domain", "creative commons"]
# Python's IGNORECASE folds Unicode (long s matches s); Java needs (?u) for
# that, RE2 does it under (?i) alone.
FORMAT_RE_JAVA = r"(?iu)\.(csv|xlsx?|json|xml|zip|shp|kml|txt|pdf)"
FORMAT_RE_RE2 = r"(?i)\.(csv|xlsx?|json|xml|zip|shp|kml|txt|pdf)"
NOT_FOUND = "Not found"
NOT_DETECTED = "Not detected"
NONE_DETECTED = "None detected"
ERROR_TITLE = "Error scraping website"
ERROR_VALUE = "N/A"

#: Lower-cased href contains one of the download extensions.
DOWNLOAD_LINK_RE = r"\.(csv|json|zip|xlsx|xml)"

# Reply tables. ``WS`` stands in for Python's ``\s``; scores are digits of any script, as ``\d`` is there.
STRICT_REPLY_RE = (
    "(?s)\\|" + WS + "*(.*?)" + WS + "*\\|"
    + WS + "*F-Score \\((\\p{Nd}+)/17\\)" + WS + "*\\|"
    + WS + "*A-Score \\((\\p{Nd}+)/10\\)" + WS + "*\\|"
    + WS + "*I-Score \\((\\p{Nd}+)/8\\)" + WS + "*\\|"
    + WS + "*R-Score \\((\\p{Nd}+)/7\\)" + WS + "*\\|"
)
LENIENT_REPLY_RE = (
    "(?s)\\|" + WS + "*(.*?)" + WS + "*\\|"
    + WS + "*F-Score \\((\\p{Nd}+)/17\\)"
    + ".*A-Score \\((\\p{Nd}+)/10\\)"
    + ".*I-Score \\((\\p{Nd}+)/8\\)"
    + ".*R-Score \\((\\p{Nd}+)/7\\)"
)
#: What the Spark side scans for instead: every score cell (F with the pipe before
#: it), and a strict row without its name. Nothing here gives back what it took.
SCORE_CELLS_RE = (
    "\\|" + WS + "*+F-Score \\(\\p{Nd}++/17\\)"
    + "|A-Score \\(\\p{Nd}++/10\\)|I-Score \\(\\p{Nd}++/8\\)|R-Score \\(\\p{Nd}++/7\\)"
)
STRICT_ROW_RE = (
    "\\|" + WS + "*+F-Score \\((\\p{Nd}++)/17\\)" + WS + "*+\\|"
    + WS + "*+A-Score \\((\\p{Nd}++)/10\\)" + WS + "*+\\|"
    + WS + "*+I-Score \\((\\p{Nd}++)/8\\)" + WS + "*+\\|"
    + WS + "*+R-Score \\((\\p{Nd}++)/7\\)" + WS + "*+\\|"
)
#: One score cell per principle, for row counts.
SCORE_CELL_RE = {
    "f": r"F-Score \(\p{Nd}+/17\)",
    "a": r"A-Score \(\p{Nd}+/10\)",
    "i": r"I-Score \(\p{Nd}+/8\)",
    "r": r"R-Score \(\p{Nd}+/7\)",
}
