"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

import string

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

URL_CASCADE = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), h AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u
), r(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT host, path, max_by(rhost || rpath, length(rhost || rpath) * 100000 + length(rhost)) AS rule,
         max_by(verdict, length(rhost || rpath) * 100000 + length(rhost)) AS verdict
  FROM (SELECT DISTINCT host, path FROM h), r
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN fits USING (host, path)
"""

CONTENT_SORT = f"""
WITH n AS (
  SELECT doc_id, sha256(coalesce(translate(text, '{UPPER}', '{LOWER}'), '')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM n
"""

#: Position (and with it the order) is left out: the schedules' inverse is checked by tests.
MIXING = r"""
WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, source,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS place FROM documents
), p AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS turn FROM d GROUP BY source
), w AS (
  SELECT *, CASE turn WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END AS weight, 2.0 * source_size AS most FROM s
), f AS (
  SELECT *, row_number() OVER (ORDER BY most / weight, source IS NULL, encode(source)) AS k FROM w
), l AS (
  SELECT a.*, (1.5 * (SELECT sum(source_size) FROM f) - coalesce((SELECT sum(most) FROM f b WHERE b.k < a.k), 0))
              / ((SELECT sum(weight) FROM f) - coalesce((SELECT sum(weight) FROM f b WHERE b.k < a.k), 0)) AS level FROM f a
), o AS (
  SELECT min(k) AS k, min_by(level, k) AS level FROM l WHERE most / weight > level
), t AS (
  SELECT l.source, l.source_size, turn, CAST(CASE WHEN l.k >= o.k THEN o.level * weight ELSE most END AS DOUBLE) AS target
  FROM l LEFT JOIN o ON true
), c AS (
  SELECT doc_id, size, source_size, target, turn, start, greatest(0, least(floor(target), start + size) - start) AS first,
         greatest(0, least(floor(target), source_size + start + size) - source_size - start) AS second
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, CASE WHEN first > 0 THEN least(1.0, (CAST(start AS DOUBLE) + CAST(first AS DOUBLE) / 2) / target) END AS share FROM c
)
SELECT doc_id, size, source_size, target, CAST(first + second AS BIGINT) AS taken,
       -- Where the demand is due: the roots of 1.5t - t*t/2 = share (a rate that fades from 1.5 to 0.5),
       -- of t/2 (to 0.5) and t/2 + 1.5(t - 0.5)^2 (a rate that rises to 2) = 0.875 share, and t = share.
       round(CASE turn WHEN 0 THEN 1.5 - sqrt(2.25 - 2 * share)
             WHEN 1 THEN CASE WHEN 0.875 * share <= 0.25 THEN 1.75 * share ELSE 0.5 + (sqrt(0.25 + 6 * (0.875 * share - 0.25)) - 0.5) / 3 END
             ELSE share END, 9) AS position
FROM q
"""

FLAT_GRAPH = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), u AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(e, e) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) >= 0.9 * a.n * b.n
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a) USING (vec_id)
JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) USING (vec_id)
"""

PARITY_JOIN = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
    THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ') || ' ' || len(w)] ELSE [] END) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

#: Words of letters and digits; hex digits of a text as numbers.
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: CRC-32 byte by byte, each byte's eight shifts by a list.
CRC_TABLE = """
  SELECT list(v ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_prepend(b, CAST(range(8) AS BIGINT[])), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS v
    FROM (SELECT range AS b FROM range(256)))"""


def crc32(text: str) -> str:
    of_bytes = f"list_transform(range(1, strlen({text}) + 1), lambda i: CAST('0x' || substr(hex({text}), 2 * i - 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {of_bytes}), lambda x, y: xor(x // 256, crc[xor(x % 256, y) + 1])), 4294967295)"


def _merkle_leaf(n_chars: str) -> str:
    fields = ["doc_id", "source", "lang", n_chars, "text"]
    return "sha256(concat(" + ", ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + "))"


#: Levels of all trees, then a walk up from each leaf with its siblings; twice: per lang, over the subroots.
MERKLE = f"""
WITH RECURSIVE c AS ({CRC_TABLE}
), l AS (
  SELECT doc_id, lang, {_merkle_leaf('n_chars')} AS leaf,
    CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_merkle_leaf('(n_chars + 1)')} ELSE {_merkle_leaf('n_chars')} END AS shown,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
  FROM documents, c
), t(lang, level, pos, digest, n) AS (
  SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM l
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, level, pos // 2, n
), s AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS pos FROM t WHERE n = 1
), u(level, pos, digest, n) AS (
  SELECT 0, pos, subroot, count(*) OVER () FROM s
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY level, pos // 2, n
), h AS (
  SELECT DISTINCT lang, level FROM t WHERE n > 1
), p(doc_id, lang, level, pos, folded, proof) AS (
  SELECT doc_id, lang, 0, pos, shown, '' FROM l
  UNION ALL
  SELECT doc_id, p.lang, p.level + 1, p.pos // 2,
    sha256(CASE WHEN digest IS NULL THEN folded WHEN p.pos % 2 = 1 THEN digest || folded ELSE folded || digest END), proof || coalesce(digest, '')
  FROM p JOIN h ON p.lang IS NOT DISTINCT FROM h.lang AND p.level = h.level
  LEFT JOIN t ON t.lang IS NOT DISTINCT FROM p.lang AND t.level = p.level AND t.pos = xor(p.pos, 1)
), g AS (
  SELECT DISTINCT level FROM u WHERE n > 1
), w(doc_id, lang, level, pos, folded, proof) AS (
  SELECT doc_id, p.lang, 0, s.pos, folded, proof FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang
  WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.lang IS NOT DISTINCT FROM p.lang AND h.level = p.level)
  UNION ALL
  SELECT doc_id, lang, w.level + 1, w.pos // 2,
    sha256(CASE WHEN digest IS NULL THEN folded WHEN w.pos % 2 = 1 THEN digest || folded ELSE folded || digest END), proof || coalesce(digest, '')
  FROM w JOIN g USING (level) LEFT JOIN u ON u.level = w.level AND u.pos = xor(w.pos, 1)
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM w JOIN (SELECT max(level) AS level, max_by(digest, level) AS root FROM u) USING (level)
JOIN l USING (doc_id) JOIN s ON s.lang IS NOT DISTINCT FROM l.lang
"""

POSTINGS = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS w FROM benchmark
), q AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2), lambda i: array_to_string(w[i:i + 9], ' '))) AS run
  FROM b WHERE len(w) > 0
), r AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM q)
), h AS (
  SELECT doc_id, i, r.n, item_id FROM r JOIN q ON q.n = r.n AND q.run = array_to_string(w[i:i + r.n - 1], ' ')
), c AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

LENGTH_CRC = rf"""
WITH c AS ({CRC_TABLE}
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS w FROM documents
), b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS w FROM benchmark
), f AS (
  SELECT w, count(*) FILTER (raw) AS s, count(*) FILTER (NOT raw) AS t
  FROM (SELECT unnest(w) AS w, true AS raw FROM d UNION ALL SELECT unnest(w), false FROM b) GROUP BY w
), k AS (
  SELECT w, s, t, {crc32('w')} % 10000 AS bucket
  FROM f, c
), g AS (
  SELECT bucket, CAST(floor(1000 * ln((sum(t) + 1) * ((SELECT sum(s) FROM k) + 10000) / ((sum(s) + 1) * ((SELECT sum(t) FROM k) + 10000)))) AS BIGINT) AS gain
  FROM k GROUP BY bucket
), n AS (
  SELECT doc_id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM (SELECT doc_id, unnest(w) AS w FROM d) JOIN k USING (w) JOIN g USING (bucket) GROUP BY doc_id
), r AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN n USING (doc_id)
), o AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM r WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN rank <= 10 * (SELECT count(*) FROM o) // 100 THEN rank END AS rank
FROM r LEFT JOIN o USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op5_flat_graph": FLAT_GRAPH,
    "op6_curriculum": MIXING,
    "op7_url_cascade": URL_CASCADE,
    "op8_parity_join": PARITY_JOIN,
    "op9_content_sort": CONTENT_SORT,
    "op11_merkle": MERKLE,
    "op12_postings": POSTINGS,
    "op13_length_crc": LENGTH_CRC,
}
