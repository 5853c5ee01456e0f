"""DuckDB SQL for every registered query — the cross-engine check.

The SQL is an independent formulation of the same semantics (window
de-duplication instead of a salted aggregate, a plain join, ``rank()``
instead of a histogram); it shares only the regex constants and fixed texts
with the Spark side. Views ``pages nation region`` are expected to exist.
"""

from __future__ import annotations

import html.entities
import re

from fairgauge.functions import patterns as P
from fairgauge.functions.text import JVM_ENTITIES, LEGACY_NAMES, OTHER_DIGITS
from fairgauge.operators.extract import ERROR_MESSAGES
from fairgauge.operators.results import DISPLAY_A
from fairgauge.plans import fixtures as X
from fairgauge.plans import strategies as S
from fairgauge.sources.records import OPEN_QUOTE, TOO_MANY

_FIELD = re.compile(r"\{(\w+)\}")


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS_CHARS = "(" + " || ".join(f"chr({ord(c)})" for c in P.PY_WHITESPACE) + ")"


def strip(e: str) -> str:
    return f"trim({e}, {WS_CHARS})"


# The common references plus the Latin-1 names, '&amp;' last (no decoded
# value contains '&', so the chain never decodes its own output); then the names
# that count without ';', longest first.
_ORACLE_ENTITIES = [x for x in JVM_ENTITIES if x[0] != "&amp;"] + [
    (f"&{html.entities.codepoint2name[cp]};", chr(cp)) for cp in range(160, 256)
    if f"&{html.entities.codepoint2name[cp]};" not in dict(JVM_ENTITIES)
] + [("&#00000000000000000065;", "A")]


def unesc(e: str) -> str:
    for ref, value in _ORACLE_ENTITIES:
        e = f"replace({e}, {q(ref)}, {q(value)})"
    for name in LEGACY_NAMES:
        if html.entities.html5[name] != "&":
            e = f"regexp_replace({e}, {q(f'&{name};?')}, {q(html.entities.html5[name])}, 'g')"
    return f"regexp_replace({e}, '&(amp|AMP);?', '&', 'g')"


def attribute(tag: str, name: str) -> str:
    every = f"regexp_extract_all(regexp_replace({tag}, {q(P.TAG_HEAD_RE)}, ''), {q(P.ATTRIBUTE_RE)}, 0)"
    first = f"list_filter({every}, lambda a: lower(regexp_extract(a, {q(P.ATTRIBUTE_RE)}, 1)) = {q(name)})[1]"
    return unquote(f"regexp_extract({first}, {q(P.ATTRIBUTE_RE)}, 2)")


HELD_BACK = f"chr({ord(P.HELD)})"


def unquote(e: str) -> str:
    return f"(CASE WHEN left({e}, 1) IN ('\"', '''') THEN substring({e}, 2, length({e}) - 2) ELSE {e} END)"


def py_repr(x: str) -> str:
    esc = f"replace(replace(replace(replace({x}, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    other = "regexp_matches(c, '[\\p{Cc}\\p{Cf}\\p{Zs}\\p{Zl}\\p{Zp}]') AND c <> ' '"
    code = "CASE WHEN unicode(c) < 256 THEN format('\\x{:02x}', unicode(c)) WHEN unicode(c) < 65536 THEN format('\\u{:04x}', unicode(c)) ELSE format('\\U{:08x}', unicode(c)) END"
    esc = f"array_to_string(list_transform(regexp_extract_all({esc}, '(?s).'), lambda c: CASE WHEN {other} THEN {code} ELSE c END), '')"
    return (
        f"(CASE WHEN contains({x}, '''') AND NOT contains({x}, '\"') THEN '\"' || {esc} || '\"' "
        f"ELSE '''' || replace({esc}, '''', '\\''') || '''' END)"
    )


def py_list(e: str) -> str:
    return f"('[' || array_to_string(list_transform({e}, lambda x: {py_repr('x')}), ', ') || ']')"


def fstr(e: str) -> str:
    return f"coalesce(CAST({e} AS VARCHAR), 'nan')"


def render(template: str, values: dict[str, str]) -> list[str]:
    parts = _FIELD.split(template)
    out = []
    for i, part in enumerate(parts):
        if i % 2:
            out.append(values[part])
        elif part:
            out.append(q(part))
    return out


def url_key(e: str) -> str:
    return f"regexp_replace({strip(e)}, '(?s)#.*', '')"


# ---------------------------------------------------------------------------
# Fixture CTEs (mirror fairgauge.plans.fixtures)
# ---------------------------------------------------------------------------
OVERLAY = f"""
pg AS (
  SELECT page_id, url,
    replace(replace(replace(
      CASE WHEN page_id % 7 = 0 THEN regexp_replace(html, '<title>[^<]*</title>', '', 'g')
           WHEN page_id % 11 = 0 THEN regexp_replace(html, '<title>[^<]*</title>', '<title></title>', 'g')
           WHEN page_id % 13 = 12 THEN replace(html, '<title>', '<title><b>bold</b> ')
           ELSE html END,
      '</head>', concat(CASE WHEN page_id % 33 = 3 THEN '<meta name="description">'
                             WHEN page_id % 3 = 0 THEN concat('<meta name="description" content="  About &amp; around ', CAST(page_id AS VARCHAR), ' ">')
                             WHEN page_id % 3 = 1 THEN '<meta name="Description" content="wrong case">'
                             ELSE {q(X.LOOKALIKE_META)} END, '</head>')),
      '</nav>', concat(CASE WHEN page_id % 2 = 0 THEN concat('<a href="/data/F', CAST(page_id AS VARCHAR), '.CSV?x=1&amp;y=2">d</a><a class="k" href="/z.zip">z</a><a href="/z.zip">z</a><a href="/r.pdf">r</a>') WHEN page_id % 6 = 1 THEN {q(X.AWKWARD_TAGS)} ELSE '' END, '</nav>')),
      '</article>', concat(CASE WHEN page_id % 5 = 0 THEN '<p>Released as <i>CC-BY</i> or public domain</p>'
                                WHEN page_id % 5 = 1 THEN '<!-- license --><script>var k="creativecommons";</script>'
                                ELSE '' END, '</article>')) AS html
  FROM pages)"""

CATALOG = """
cat AS (
  SELECT page_id * 4 AS row_id, 'DS' || CAST(page_id AS VARCHAR) AS dataset_name,
    CASE page_id % 4 WHEN 1 THEN url || ' ' WHEN 2 THEN regexp_replace(url, '#.*$', '') || '#sec' ELSE url END AS website_link
  FROM pages
  UNION ALL
  SELECT page_id * 4 + 1, 'MIRROR' || CAST(page_id AS VARCHAR), (SELECT arg_min(url, page_id) FROM pages) FROM pages
  UNION ALL
  SELECT CAST(n_nationkey AS BIGINT) * 4 + 2, n_name, 'http://missing.example.test/' || CAST(n_nationkey AS VARCHAR) FROM nation
  UNION ALL
  SELECT CAST(r_regionkey AS BIGINT) * 4 + 3, r_name, CAST(NULL AS VARCHAR) FROM region)"""


def _stub(k: str) -> str:
    d = lambda e: f"CAST({e} AS VARCHAR)"
    hdr = q("| Dataset Name | F-Score (X/17) | A-Score (X/10) | I-Score (X/8) | R-Score (X/7) |\n|---|---|---|---|---|\n")
    return f"""(CASE ({k}) % 8
    WHEN 0 THEN concat('| DS', {d(k)}, ' | F-Score (', {d(f'({k}) % 20')}, '/17) | A-Score (', {d(f'({k}) % 13')}, '/10) | I-Score (', {d(f'({k}) % 9')}, '/8) | R-Score (', {d(f'({k}) % 9')}, '/7) |')
    WHEN 1 THEN concat('| DS', {d(k)}, ' | F-Score (', {d(f'({k}) % 18')}, '/17) | A-Score (', {d(f'({k}) % 11')}, '/10) | I-Score (', {d(f'({k}) % 9')}, '/8) | R-Score (', {d(f'({k}) % 8')}, '/7)')
    WHEN 2 THEN concat({hdr}, '| DS', {d(k)}, ' | ', {d(f'({k}) % 18')}, ' | 8 | 7 | 4 |')
    WHEN 3 THEN concat({hdr}, '| DS', {d(k)}, ' | F-Score (', {d(f'({k}) % 18')}, '/17) | A-Score (8/10) | I-Score (7/8) | R-Score (4/7) |')
    WHEN 4 THEN concat('| EX | F-Score (9/17) | A-Score (8/10) | I-Score (7/8) | R-Score (4/7) |', chr(10), '| DS', {d(k)}, ' | F-Score (', {d(f'({k}) % 18')}, '/17) | A-Score (', {d(f'({k}) % 11')}, '/10) | I-Score (', {d(f'({k}) % 9')}, '/8) | R-Score (', {d(f'({k}) % 8')}, '/7) |')
    WHEN 5 THEN concat('Sure.', chr(10), '|  DS', {d(k)}, '  |  F-Score (', {d(f'({k}) % 18')}, '/17)|A-Score (3/10) |', chr(10), ' I-Score (2/8) | R-Score (1/7) |')
    WHEN 6 THEN ''
    ELSE CAST(NULL AS VARCHAR) END)"""


# ---------------------------------------------------------------------------
# Extraction
# ---------------------------------------------------------------------------
RUNS_RE = P.WS + "*" + P.NODE_SEP_RE + "[" + P.WS[1:-1] + P.NODE_SEP_RE + "]*"

EXTRACT = f"""
s0 AS (
  SELECT page_id, url, html,
    regexp_replace(translate(html, chr(1), {HELD_BACK}), {q(P.HIDDEN_RE)}, {q(P.HIDDEN_MARK)}, 'g') AS clean
  FROM pg),
s1 AS (
  SELECT *,
    regexp_replace(clean, {q(P.TAG_RE_RE2)}, chr(1), 'g') AS marked,
    regexp_extract(clean, {q(P.TITLE_RE)}, 1) AS title_in,
    regexp_matches(clean, {q(P.TITLE_OPEN_RE)}) AS has_title,
    list_filter(regexp_extract_all(clean, {q(P.META_TAG_RE_RE2)}, 0), lambda t: {attribute('t', 'name')} = 'description')[1] AS desc_tag,
    list_filter(list_transform(regexp_extract_all(clean, {q(P.ANCHOR_TAG_RE_RE2)}, 0), lambda t: {attribute('t', 'href')}), lambda h: h IS NOT NULL) AS hrefs,
    translate({strip(f"regexp_replace({unesc('marked')}, {q(RUNS_RE)}, ' ', 'g')")}, {HELD_BACK}, chr(1)) AS txt
  FROM s0),
s2 AS (
  SELECT *,
    {attribute('desc_tag', 'content')} AS content,
    list_filter(list_transform(hrefs, lambda h: translate({unesc('h')}, {HELD_BACK}, chr(1))), lambda h: regexp_matches(lower(h), {q(P.DOWNLOAD_LINK_RE)})) AS links,
    list_sort(list_distinct(regexp_extract_all(html, {q(P.FORMAT_RE_RE2)}, 1))) AS formats,
    concat_ws(', ', {", ".join(f"CASE WHEN contains(lower(txt), {q(k.lower())}) THEN {q(k)} END" for k in P.LICENSE_KEYWORDS)}) AS lic,
    CASE WHEN html IS NULL THEN 'no_page'
         WHEN has_title AND title_in = '' THEN 'empty_title'
         WHEN has_title AND regexp_matches(title_in, {q(P.NESTED_MARKUP_RE)}) THEN 'nested_title'
         WHEN desc_tag IS NOT NULL AND content IS NULL THEN 'meta_without_content'
    END AS scrape_error
  FROM s1),
ex AS (
  SELECT page_id, url, {url_key('url')} AS url_key, scrape_error, scrape_error IS NULL AS scrape_ok,
    CASE WHEN scrape_error IS NULL THEN (CASE WHEN NOT has_title THEN 'Not found' ELSE {strip(unesc('title_in'))} END) END AS title,
    CASE WHEN scrape_error IS NULL THEN (CASE WHEN desc_tag IS NULL THEN 'Not found' ELSE {strip(unesc('content'))} END) END AS description,
    CASE WHEN scrape_error IS NULL THEN (CASE WHEN lic = '' THEN 'Not detected' ELSE lic END) END AS license_info,
    CASE WHEN scrape_error IS NULL THEN (CASE WHEN len(formats) = 0 THEN ['None detected'] ELSE formats END) END AS file_formats,
    CASE WHEN scrape_error IS NULL THEN (CASE WHEN len(links) = 0 THEN ['None detected'] ELSE links END) END AS download_links,
    CASE WHEN scrape_error IS NULL THEN substring(txt, 1, 2000) END AS raw_text_snippet,
    txt
  FROM s2)"""

_MSG = "CASE scrape_error " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in ERROR_MESSAGES.items()) + " END"

JOINED = f"""
ck AS (SELECT *, {url_key('website_link')} AS url_key FROM cat),
pu AS (SELECT * FROM ex WHERE url_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY page_id) = 1),
joined AS (
  SELECT ck.row_id, ck.dataset_name, ck.website_link, ck.url_key, pu.page_id,
    pu.title, pu.description, pu.license_info, pu.file_formats, pu.download_links, pu.raw_text_snippet,
    CASE WHEN pu.page_id IS NULL THEN 'no_page' ELSE pu.scrape_error END AS scrape_error
  FROM ck LEFT JOIN pu ON ck.url_key = pu.url_key)"""

_STRATS = ", ".join(f"({q(s['strategy'])}, {q(s['dialect'])}, {i})" for i, s in enumerate(S.STRATEGIES))
FILLED = f"""
strat AS (SELECT * FROM (VALUES {_STRATS}) t(strategy, dialect, strategy_ord)),
filled AS (
  SELECT j.row_id, j.dataset_name, j.website_link, j.page_id, s.strategy, s.dialect, s.strategy_ord,
    j.scrape_error, j.scrape_error IS NULL AS scrape_ok,
    CASE WHEN j.scrape_error IS NULL THEN j.title ELSE {q(P.ERROR_TITLE)} END AS title,
    CASE WHEN j.scrape_error IS NULL THEN j.description ELSE ({_MSG.replace('scrape_error', 'j.scrape_error')}) END AS description,
    CASE WHEN j.scrape_error IS NULL THEN j.license_info ELSE {q(P.ERROR_VALUE)} END AS license_info,
    CASE WHEN j.scrape_error IS NULL THEN j.file_formats WHEN s.dialect = 'A' THEN [{q(P.ERROR_VALUE)}] ELSE CAST([] AS VARCHAR[]) END AS file_formats,
    CASE WHEN j.scrape_error IS NULL THEN j.download_links WHEN s.dialect = 'A' THEN [{q(P.ERROR_VALUE)}] ELSE CAST([] AS VARCHAR[]) END AS download_links,
    CASE WHEN j.scrape_error IS NULL THEN j.raw_text_snippet ELSE '' END AS raw_text_snippet
  FROM joined j CROSS JOIN strat s)"""

_V = {
    "title": "title", "description": "description", "license_info": "license_info",
    "file_formats_list": py_list("file_formats"),
    "file_formats_joined": "array_to_string(file_formats, ', ')",
    "download_links_list": py_list("download_links"),
    "raw_text_snippet": "raw_text_snippet",
    "dataset_name": fstr("dataset_name"), "website_link": fstr("website_link"),
}
_EXAMPLES = "CASE strategy " + " ".join(
    f"WHEN {q(s['strategy'])} THEN {q(s['examples'])}" for s in S.STRATEGIES) + " END"
_SYSTEM = "CASE strategy " + " ".join(
    f"WHEN {q(s['strategy'])} THEN {q(s['system'])}" for s in S.STRATEGIES) + " END"
_MAXTOK = "CASE strategy " + " ".join(
    f"WHEN {q(s['strategy'])} THEN {s['max_tokens']}" for s in S.STRATEGIES) + " END"
_USER_A = "concat(" + ", ".join([q(S.RUBRIC)] + render(S.EVIDENCE_A, _V) + render(S.INSTRUCTION_A, _V)) + ")"
_USER_B = "concat(" + ", ".join([q(S.RUBRIC), _EXAMPLES] + render(S.EVIDENCE_B, _V) + render(S.INSTRUCTION_B, _V)) + ")"

PROMPTS = f"""
prompts AS (
  SELECT *, CASE WHEN dialect = 'A' THEN {_USER_A} ELSE {_USER_B} END AS user_content,
    {_SYSTEM} AS system_content, CAST({_MAXTOK} AS INTEGER) AS max_tokens
  FROM filled),
reqs AS (
  SELECT *, sha256(concat_ws(chr(1), strategy, CAST(row_id AS VARCHAR), {q(S.MODEL)}, {q(str(S.TEMPERATURE))}, CAST(max_tokens AS VARCHAR),
    system_content, user_content)) AS request_id FROM prompts)"""


def digits(e: str) -> str:
    return f"translate({e}, {q(''.join(OTHER_DIGITS))}, {q(''.join(OTHER_DIGITS.values()))})"


def _parse_cols(r: str, pat: str) -> dict[str, str]:
    ok = f"coalesce(regexp_matches({r}, {q(pat)}), false)"
    cols = {"parse_ok": ok, "parsed_dataset_name": f"CASE WHEN {ok} THEN {strip(f'regexp_extract({r}, {q(pat)}, 1)')} END"}
    for i, name in enumerate(("f_score", "a_score", "i_score", "r_score"), start=2):
        cols[name] = f"CASE WHEN {ok} THEN TRY_CAST({digits(f'regexp_extract({r}, {q(pat)}, {i})')} AS BIGINT) END"
    return cols


def _validity(prefix: str = "") -> str:
    checks = {letter: f"coalesce({prefix}{letter}_score BETWEEN 0 AND {mx}, false)" for _, letter, mx in S.PRINCIPLES}
    valid_scores = f"coalesce({prefix}parse_ok AND " + " AND ".join(checks.values()) + ", false)"
    parts = [f"{valid_scores} AS valid_scores"]
    parts += [f"{c} AS {letter}_valid" for letter, c in checks.items()]
    parts.append("(" + " AND ".join(checks.values()) + ") AS all_valid")
    return ", ".join(parts)


_STRICT = _parse_cols("response", P.STRICT_REPLY_RE)
_LENIENT = _parse_cols("response", P.LENIENT_REPLY_RE)
_BY_DIALECT = ", ".join(
    f"CASE WHEN dialect = 'A' THEN {_STRICT[k]} ELSE {_LENIENT[k]} END AS {k}" for k in _STRICT
)
_MULTI = f"coalesce(len(regexp_extract_all(response, {q(P.SCORE_CELL_RE['f'])}, 0)) > 1, false)"

_K = "(row_id + strategy_ord)"
UNIFIED = f"""
replies AS (
  SELECT request_id, {_stub(_K)} AS response FROM reqs
  UNION ALL
  SELECT request_id, CASE WHEN {_K} % 8 = 0 THEN '' WHEN {_K} % 8 IN (3, 5) THEN {q(X.BARE_REPLY)} END FROM reqs WHERE {_K} % 8 IN (0, 1, 3, 5, 6)),
best AS (
  SELECT request_id, response, count(*) OVER (PARTITION BY request_id) AS reply_count FROM replies
  QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY CASE WHEN regexp_matches(response, {q(P.STRICT_REPLY_RE)}) THEN 0
    WHEN regexp_matches(response, {q(P.LENIENT_REPLY_RE)}) THEN 1 WHEN trim(response) <> '' THEN 2 WHEN response IS NOT NULL THEN 3 ELSE 4 END, response) = 1),
answered AS (SELECT reqs.*, response, coalesce(reply_count, 0) AS reply_count FROM reqs LEFT JOIN best USING (request_id)),
parsed AS (SELECT *, {_BY_DIALECT} FROM answered),
uni AS (
  SELECT strategy, dialect, row_id, request_id, dataset_name, website_link,
    response AS fair_raw_output, title AS scraped_title, license_info AS scraped_license,
    file_formats AS scraped_file_formats, scrape_error, parse_ok AS parse_success,
    parsed_dataset_name, f_score, a_score, i_score, r_score, {_validity()},
    {_MULTI} AS multi_row_reply, reply_count
  FROM parsed)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_EXTRACT_CHAIN = (OVERLAY, EXTRACT)
_JOIN_CHAIN = (OVERLAY, EXTRACT, CATALOG, JOINED)
_REQ_CHAIN = _JOIN_CHAIN + (FILLED, PROMPTS)
_UNI_CHAIN = _REQ_CHAIN + (UNIFIED,)

SEP = " || "


def _page_field(expr: str, alias: str) -> str:
    return _with(*_EXTRACT_CHAIN) + f"SELECT page_id, scrape_error, {expr} AS {alias} FROM ex"


_TURN_ROWS = "concat('| EX | F-Score (1/17) |', coalesce(text, ''), ' | I-Score (2/8) | A-Score (3/10) |')"
_TURN_STUB = f"coalesce({_stub('k')}, '')"
TURNS = f"""
  SELECT conv_id, turn, CASE k % 5 WHEN 0 THEN concat(text, chr(10), {_TURN_STUB}, chr(10), text)
    WHEN 1 THEN concat({_TURN_ROWS}, chr(10), {_TURN_STUB}) WHEN 2 THEN concat({_TURN_STUB}, chr(10), {_TURN_ROWS})
    WHEN 3 THEN {_stub('k')} ELSE text END AS response
  FROM (SELECT conv_id, turn, text, conv_id * 3 + turn AS k FROM conversations)"""


def _page_parse(pat: str) -> str:
    cols = _parse_cols("response", pat)
    body = ", ".join(f"{v} AS {k}" for k, v in cols.items())
    return f"SELECT conv_id, turn, {body} FROM ({TURNS})"


def _record(dialect: str) -> str:
    return _with(*_JOIN_CHAIN, FILLED) + f"""
SELECT row_id, dataset_name, title, description, license_info,
  array_to_string(file_formats, {q(SEP)}) AS file_formats,
  array_to_string(download_links, {q(SEP)}) AS download_links,
  raw_text_snippet, scrape_ok, scrape_error
FROM filled WHERE dialect = {q(dialect)} AND strategy_ord = {0 if dialect == 'A' else 1}"""


_A_COLS = """strategy, row_id, dataset_name, website_link, fair_raw_output, scraped_title, scraped_license,
  array_to_string(scraped_file_formats, ', ') AS scraped_file_formats, parse_success, valid_scores,
  parsed_dataset_name, f_score, a_score, i_score, r_score"""
_B_COLS = f"""strategy, row_id, dataset_name, website_link, fair_raw_output, scraped_title, scraped_license,
  {py_list('scraped_file_formats')} AS scraped_file_formats, parsed_dataset_name, f_score, a_score, i_score, r_score,
  f_valid, a_valid, i_valid, r_valid, all_valid"""
_U_COLS = """strategy, dialect, row_id, request_id, dataset_name, website_link, fair_raw_output, scraped_title,
  scraped_license, array_to_string(scraped_file_formats, ' || ') AS scraped_file_formats, scrape_error,
  parse_success, valid_scores, parsed_dataset_name, f_score, a_score, i_score, r_score,
  f_valid, a_valid, i_valid, r_valid, all_valid, multi_row_reply, reply_count"""

def _csv_cell(e: str) -> str:
    """Quoted when it holds a comma, a quote or a line end, or is empty; NULL is nothing."""
    return (
        f"(CASE WHEN {e} IS NULL THEN '' WHEN {e} = '' THEN '\"\"' WHEN regexp_matches({e}, '[,\"\\r\\n]') "
        f"THEN '\"' || replace({e}, '\"', '\"\"') || '\"' ELSE {e} END)"
    )


_CSV_CELLS = ", ".join(
    _csv_cell("array_to_string(scraped_file_formats, ', ')" if c == "scraped_file_formats" else f"CAST({c} AS VARCHAR)")
    for c in DISPLAY_A
)
CATALOG_CSV = """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Set "' || page_id || '", a' WHEN 1 THEN ' DS' || page_id || ' '
  WHEN 3 THEN 'NA' END AS dataset_name, url AS website_link
FROM pages"""

#: One record per page in the order of files and pages, then the regions' file.
CATALOG_RECORDS = """
WITH r AS (
  SELECT row_number() OVER (ORDER BY page_id // 100, page_id) - 1 AS row_id, page_id % 6 AS c,
    CAST(page_id AS VARCHAR) AS p, url FROM pages
), z AS (
  SELECT (SELECT count(*) FROM pages) + r_regionkey AS row_id, r_regionkey AS k, r_name FROM region WHERE r_regionkey < 2
)"""
_GOOD_RECORDS = CATALOG_RECORDS + """
SELECT row_id, CASE c WHEN 0 THEN 'Set "' || p || '",' || chr(13) || chr(10) || 'part two' WHEN 1 THEN '5" disk ' || p WHEN 2 THEN 'NA'
    WHEN 4 THEN 'a' || chr(10) || chr(10) || 'b ' || p ELSE 'D' || p END AS dataset_name,
  CASE WHEN c < 5 THEN url END AS website_link
FROM r WHERE c <> 3
UNION ALL SELECT row_id, r_name, 'http://region/' FROM z WHERE k = 0"""
_BAD_RECORDS = CATALOG_RECORDS + f"""
SELECT row_id, {q(TOO_MANY)} AS problem, 'D' || p || ',' || url || ',x,y' AS record FROM r WHERE c = 3
UNION ALL SELECT row_id, {q(OPEN_QUOTE)}, '"open,http://open/' FROM z WHERE k = 1"""

_PRINCIPLE_ROWS = " UNION ALL ".join(
    f"SELECT strategy, row_id, {q(name)} AS principle, {letter}_score AS score, {mx} AS max_score, {letter}_valid AS valid FROM uni"
    for name, letter, mx in S.PRINCIPLES
)
_MEANS = ", ".join(
    f"round(avg(CASE WHEN all_valid THEN {letter}_score END), 4) AS mean_{letter}" for _, letter, _ in S.PRINCIPLES
)

#: Pairs of valid rows of a dataset, by measure; the statistics below compare rows or cells
#: with each other, as their definitions say.
_MEASURE_ROWS = " UNION ALL ".join(
    f"SELECT strategy, row_id, {q(name)} AS measure, {score} AS score FROM uni WHERE all_valid"
    for name, score in [("Total", "f_score + a_score + i_score + r_score"), *[(n, f"{letter}_score") for n, letter, _ in S.PRINCIPLES]]
)
_SCORE_PAIRS = f"""m AS ({_MEASURE_ROWS}), sp AS (
  SELECT x.strategy AS strategy_a, y.strategy AS strategy_b, x.measure, x.score AS score_a, y.score AS score_b, count(*) AS n
  FROM m x JOIN m y ON x.row_id = y.row_id AND x.measure = y.measure AND x.strategy < y.strategy GROUP BY ALL
)"""
_AGREEMENT = """, ma AS (SELECT strategy_a, strategy_b, measure, score_a AS s, sum(n) AS n FROM sp GROUP BY ALL),
mb AS (SELECT strategy_a, strategy_b, measure, score_b AS s, sum(n) AS n FROM sp GROUP BY ALL),
chance AS (
  SELECT strategy_a, strategy_b, measure, sum(ma.n * mb.n * abs(ma.s - mb.s)) AS e1, sum(ma.n * mb.n * (ma.s - mb.s) * (ma.s - mb.s)) AS e2
  FROM ma JOIN mb USING (strategy_a, strategy_b, measure) GROUP BY ALL
),
ob AS (
  SELECT strategy_a, strategy_b, measure, sum(n) AS n, sum(CASE WHEN score_a = score_b THEN n ELSE 0 END) AS same,
    sum(n * (score_a - score_b)) AS diff, sum(n * abs(score_a - score_b)) AS o1, sum(n * (score_a - score_b) * (score_a - score_b)) AS o2
  FROM sp GROUP BY ALL
)
SELECT strategy_a, strategy_b, measure, CAST(n AS BIGINT) AS n, round(CAST(same AS DOUBLE) / n, 6) AS equal_share,
  round(CAST(diff AS DOUBLE) / n, 6) AS mean_difference,
  CASE WHEN e1 > 0 THEN round(CAST(e1 - n * o1 AS DOUBLE) / CAST(e1 AS DOUBLE), 6) END AS kappa_linear,
  CASE WHEN e2 > 0 THEN round(CAST(e2 - n * o2 AS DOUBLE) / CAST(e2 AS DOUBLE), 6) END AS kappa_quadratic
FROM ob JOIN chance USING (strategy_a, strategy_b, measure)"""
_RANK_CORRELATION = """, pc AS (
  SELECT strategy_a, strategy_b, measure, x.n * y.n AS w, sign(x.score_a - y.score_a) AS da, sign(x.score_b - y.score_b) AS db
  FROM sp x JOIN sp y USING (strategy_a, strategy_b, measure)
),
co AS (
  SELECT strategy_a, strategy_b, measure, sum(CASE WHEN da * db > 0 THEN w ELSE 0 END) / 2 AS c,
    sum(CASE WHEN da * db < 0 THEN w ELSE 0 END) / 2 AS d, sum(CASE WHEN da <> 0 THEN w ELSE 0 END) / 2 AS ua,
    sum(CASE WHEN db <> 0 THEN w ELSE 0 END) / 2 AS ub
  FROM pc GROUP BY ALL
)
SELECT strategy_a, strategy_b, measure, CAST(n AS BIGINT) AS n, CAST(c AS DOUBLE) AS concordant, CAST(d AS DOUBLE) AS discordant,
  CASE WHEN ua > 0 AND ub > 0 THEN round(CAST(c - d AS DOUBLE) / sqrt(CAST(ua AS DOUBLE) * CAST(ub AS DOUBLE)), 6) END AS tau_b
FROM co JOIN (SELECT strategy_a, strategy_b, measure, sum(n) AS n FROM sp GROUP BY ALL) USING (strategy_a, strategy_b, measure)"""


def oracle_sql() -> dict[str, str]:
    return {
        "extract_title": _page_field("title", "title"),
        "extract_description": _page_field("description", "description"),
        "extract_text": _with(*_EXTRACT_CHAIN) + "SELECT page_id, txt AS text FROM ex",
        "extract_license": _page_field("license_info", "license_info"),
        "extract_formats": _page_field(f"array_to_string(file_formats, {q(SEP)})", "file_formats"),
        "extract_links": _page_field(f"array_to_string(download_links, {q(SEP)})", "download_links"),
        "extract_snippet": _page_field("raw_text_snippet", "raw_text_snippet"),
        "scrape_record_a": _record("A"),
        "scrape_record_b": _record("B"),
        "catalog_join": _with(*_JOIN_CHAIN)
        + "SELECT row_id, dataset_name, website_link, url_key, page_id, scrape_error FROM joined",
        "strategy_fanout": _with(*_JOIN_CHAIN, FILLED) + "SELECT row_id, strategy, dialect FROM filled",
        "prompt_user_a": _with(*_REQ_CHAIN)
        + "SELECT row_id, strategy, md5(user_content) AS content_md5, CAST(length(user_content) AS BIGINT) AS content_chars FROM reqs WHERE dialect = 'A'",
        "prompt_user_b": _with(*_REQ_CHAIN)
        + "SELECT row_id, strategy, md5(user_content) AS content_md5, CAST(length(user_content) AS BIGINT) AS content_chars FROM reqs WHERE dialect = 'B'",
        "request_envelope": _with(*_REQ_CHAIN)
        + f"SELECT request_id, strategy, row_id, {q(S.MODEL)} AS model, CAST({S.TEMPERATURE} AS DOUBLE) AS temperature, max_tokens, "
        "md5(system_content) AS system_md5, md5(user_content) AS user_md5 FROM reqs",
        "parse_strict": _page_parse(P.STRICT_REPLY_RE),
        "parse_lenient": _page_parse(P.LENIENT_REPLY_RE),
        "validate_a": f"SELECT conv_id, turn, parse_ok, f_score, a_score, i_score, r_score, {_validity()} FROM ({_page_parse(P.STRICT_REPLY_RE)})",
        "validate_b": f"SELECT conv_id, turn, parse_ok, f_score, a_score, i_score, r_score, {_validity()} FROM ({_page_parse(P.LENIENT_REPLY_RE)})",
        "reply_source": f"SELECT conv_id || '-' || turn AS request_id, response FROM ({TURNS})",
        "request_json": _with(*_REQ_CHAIN)
        + f"SELECT request_id, strategy, row_id, {q(S.MODEL)} AS model, CAST({S.TEMPERATURE} AS DOUBLE) AS temperature, max_tokens, "
        "'system' AS first_role, 'user' AS second_role, md5(system_content) AS system_md5, md5(user_content) AS user_md5 FROM reqs",
        "result_csv_line": _with(*_UNI_CHAIN) + f"SELECT row_id, concat_ws(',', {_CSV_CELLS}) AS line FROM uni WHERE dialect = 'A'",
        "catalog_csv": CATALOG_CSV,
        "catalog_records": _GOOD_RECORDS,
        "catalog_bad_records": _BAD_RECORDS,
        "result_a": _with(*_UNI_CHAIN) + f"SELECT {_A_COLS} FROM uni WHERE dialect = 'A'",
        "result_b": _with(*_UNI_CHAIN) + f"SELECT {_B_COLS} FROM uni WHERE dialect = 'B'",
        "result_unified": _with(*_UNI_CHAIN) + f"SELECT {_U_COLS} FROM uni",
        "component_scores": _with(*_UNI_CHAIN) + _PRINCIPLE_ROWS,
        "strategy_summary": _with(*_UNI_CHAIN)
        + f"""SELECT strategy, count(*) AS n_rows, CAST(sum(CAST(parse_success AS BIGINT)) AS BIGINT) AS n_parsed,
  CAST(sum(CAST(all_valid AS BIGINT)) AS BIGINT) AS n_valid, {_MEANS} FROM uni GROUP BY strategy""",
        "dataset_ranking": _with(*_UNI_CHAIN)
        + """SELECT strategy, total_score, row_id, dataset_name,
  rank() OVER (PARTITION BY strategy ORDER BY total_score DESC) AS rank
FROM (SELECT strategy, row_id, dataset_name, f_score + a_score + i_score + r_score AS total_score FROM uni WHERE all_valid)""",
        "score_pairs": _with(*_UNI_CHAIN, _SCORE_PAIRS) + "SELECT * FROM sp",
        "strategy_agreement": _with(*_UNI_CHAIN, _SCORE_PAIRS) + _AGREEMENT,
        "strategy_rank_correlation": _with(*_UNI_CHAIN, _SCORE_PAIRS) + _RANK_CORRELATION,
    }
