"""DuckDB SQL of the training-data queries that SQL can express.

Written from the operators' definitions; nothing is imported from them but
the licence texts, which are data.  Token counts, fingerprints, chunk digests,
fitted scores and segmentations have no SQL form.
"""

from __future__ import annotations

from .license_scan import KNOWN


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- embeddings: all pairs of a label, components by reachability ----------------------

EMBEDDINGS = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE len(a.v) = len(b.v)
      AND list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93),
reach AS (
    SELECT vec_id AS x, vec_id AS y FROM embeddings
    UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.x = e.vec_id) AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = e.vec_id
"""

# --- secrets ---------------------------------------------------------------------------

# Fixed values: (place in the listing, role, pattern, group whose length counts, least, below, further need).
_ASSIGN = (r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
           r"|[aA][pP][iI]_?[kK][eE][yY])[""" + "\"''" + r"""]?\x20*[:=]\x20*[""" + "\"''" + r"""]?([A-Za-z0-9+/_.=-]+)""")
_ENDPOINT = (r"(?i:https?|ftp|jdbc|postgresql|postgres|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D" + "\"''" + "<>]+")
_KINDS = (
    (0, "assign", "secret", True, _ASSIGN, 2, 6, 10**9, "true"),
    (1, "access", "id", True, "AKIA[A-Z0-9]+", 0, 20, 10**9, "true"),
    (2, "hex", "secret", True, "[0-9a-f]{24,}", 0, 24, 10**9, "true"),
    (3, "weak_assign", "secret", False, _ASSIGN, 2, 1, 6, "true"),
    (4, "weak_access", "id", False, "AKIA[A-Z0-9]+", 0, 5, 20, "true"),
    (5, "weak_hex", "secret", False, "[0-9a-f]{16,}", 0, 16, 24,
     "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-f]')"),
    (6, "opaque", "secret", False, "[A-Za-z0-9+/]{32,}", 0, 32, 10**9,
     "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')"),
    (7, "endpoint", "endpoint", False, _ENDPOINT, 0, 1, 10**9, "true"),
)


def _spans(k, name, role, strong, pattern, group, least, below, need) -> str:
    """Offsets from the running lengths of the pieces between matches and the matches."""
    return f"""
    SELECT r, {k} AS k, '{name}' AS name, '{role}' AS role, {strong} AS strong, s, s + length(m) AS e
    FROM (SELECT r, m, g, sum(length(p) + length(m)) OVER (PARTITION BY r ORDER BY i) - length(m) AS s
          FROM (SELECT r, unnest(range(1, len(ms) + 1)) AS i, unnest(ps[:len(ms)]) AS p, unnest(ms) AS m, unnest(gs) AS g
                FROM (SELECT r, string_split_regex(t, '{pattern}') AS ps, regexp_extract_all(t, '{pattern}') AS ms,
                             regexp_extract_all(t, '{pattern}', {group}) AS gs
                      FROM texts WHERE regexp_matches(t, '{pattern}'))))
    WHERE length(g) >= {least} AND length(g) < {below} AND {need}"""


SECRETS = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(_spans(*k) for k in _KINDS)}),
-- a weak span under a strong one is the same find
parts AS (SELECT * FROM found w WHERE strong OR NOT EXISTS (
    SELECT 1 FROM found b WHERE b.r = w.r AND b.strong AND b.s < w.e AND w.s < b.e)),
told AS (SELECT * FROM parts p WHERE strong OR EXISTS (
    SELECT 1 FROM parts q
    WHERE q.r = p.r AND (p.role = 'secret') <> (q.role = 'secret') AND greatest(q.s - p.e, p.s - q.e) <= 200))
SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
       count(*) FILTER (WHERE k = 2) AS n_hex,
       sha256(coalesce(string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (WHERE strong), ''))
           AS base_sha256,
       coalesce(string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, k, e), '') AS spans,
       count(*) FILTER (WHERE NOT strong) AS n_linked
FROM texts LEFT JOIN told USING (r) GROUP BY r, doc_id
"""

# --- licences --------------------------------------------------------------------------


def _canonical(x: str) -> str:
    line = (r"(?m)^[^\p{L}\p{N}\n]*(?:copyright[^\p{L}\p{N}\n]*(?:\(c\)|©|[0-9]{4})[^\n]*"
            r"|(?:\(c\)|©)[^\p{L}\n]*(?:copyright)?[^\p{L}\n]*[0-9]{4}[^\n]*|all rights reserved[^\p{L}\n]*)$")
    c = f"replace(regexp_replace(lower({x}), '{line}', '', 'g'), '&', ' and ')"
    c = rf"trim(regexp_replace({c}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    for old, new in (("licenc", "licens"), (r"\bsub licens", "sublicens"), (r"\bnon commercial\b", "noncommercial"),
                     (r"\bnon infringement\b", "noninfringement"), (r"\bcopyright owner", "copyright holder"),
                     ("organisation", "organization"), ("merchantibility", "merchantability"),
                     (r"\bv([0-9])", r"version \1")):
        c = f"regexp_replace({c}, '{old}', '{new}', 'g')"
    return c


LICENSES = f"""
WITH known AS (
    SELECT sha256({_canonical('body')}) AS digest, min(licence) AS licence
    FROM (VALUES {', '.join(f'({_lit(a)}, {_lit(b)})' for a, b in KNOWN)}) AS k(licence, body) GROUP BY digest),
texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
units AS (
    SELECT r, true AS whole, t AS u FROM texts
    UNION ALL SELECT r, false, unnest(string_split(t, chr(10))) FROM texts
    UNION ALL SELECT r, false, unnest(string_split_regex(t, '\\n[\\x20\\t\\r]*\\n\\s*')) FROM texts),
hits AS (
    SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences,
           max(licence) FILTER (WHERE whole) AS whole_text, count(DISTINCT digest) AS n_units
    FROM (SELECT r, whole, sha256({_canonical('u')}) AS digest FROM units) JOIN known USING (digest) GROUP BY r)
SELECT doc_id, licences, whole_text, coalesce(n_units, 0) AS n_units FROM texts LEFT JOIN hits USING (r)
"""

# --- URLs ------------------------------------------------------------------------------

# Every subset of a labelled URL's tokens is counted, which asks for few tokens per URL.
URLS = r"""
WITH urls AS (
    SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
cut AS (
    SELECT page_id, url, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM urls),
rules(name, h, p, v) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
    ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
    ('com/de/', 'com', '/de/', 'block')),
ruled AS (
    SELECT *, (SELECT arg_max({'name': name, 'v': v}, length(name)) FROM rules
               WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best
    FROM cut),
sets AS (
    SELECT DISTINCT url, list_sort(list_distinct(list_concat(
        list_transform(range(1, len(string_split(host, '.')) + 1),
                       lambda i: 'host:' || array_to_string(string_split(host, '.')[i:], '.')),
        list_transform(list_filter(string_split_regex(lower(path), '[/._-]+'), lambda w: w <> ''),
                       lambda w: 'path:' || regexp_replace(w, '[0-9]+', '#', 'g')),
        list_transform(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> ''),
                       lambda p: 'key:' || string_split(p, '=')[1]),
        list_transform(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> ''),
                       lambda p: 'pair:' || p),
        ['scheme:' || lower(string_split(url, '://')[1])],
        CASE WHEN contains(url, '#') THEN ['fragment:' || string_split(url, '#')[-1]] ELSE [] END))) AS tokens
    FROM cut WHERE contains(url, '://')),
labelled AS (
    SELECT row_number() OVER () AS n, tokens, bad FROM pages JOIN (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels GROUP BY doc_id)
        ON page_id = doc_id JOIN sets USING (url) WHERE bad IS NOT NULL),
-- of tokens of the same labelled URLs the first stands for all
stands AS (SELECT t, min(t) OVER (PARTITION BY seen) AS rep
           FROM (SELECT t, list(n ORDER BY n) AS seen FROM (SELECT n, unnest(tokens) AS t FROM labelled) GROUP BY t)),
marked AS (SELECT n, list_intersect(tokens, (SELECT list(DISTINCT rep) FROM stands)) AS tokens, bad FROM labelled),
total AS (SELECT count(*) AS n FROM marked),
subsets AS (
    SELECT list_sort(list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1)) AS tokens, bad
    FROM (SELECT tokens, bad, unnest(range(1, 1 << len(tokens))) AS mask FROM marked)),
mined AS (
    SELECT tokens, count(*) FILTER (WHERE bad) / count(*) AS confidence, count(*) FILTER (WHERE bad) / any_value(n) AS support
    FROM subsets, total GROUP BY tokens
    HAVING count(*) FILTER (WHERE bad) >= ceil(0.002 * any_value(n)) AND count(*) FILTER (WHERE bad) >= 0.6 * count(*)
       AND count(*) FILTER (WHERE bad) > 0),
-- and a URL has it where it has any of them
mapped AS (SELECT url, list_distinct(list(coalesce(rep, t))) AS tokens
           FROM (SELECT url, unnest(tokens) AS t FROM sets) LEFT JOIN stands USING (t) GROUP BY url),
matched AS (
    SELECT url, min({'c': -confidence, 's': -support, 't': m.tokens}) AS b
    FROM mapped JOIN mined m ON list_has_all(mapped.tokens, m.tokens) GROUP BY url)
SELECT page_id, host, path, best.name AS rule,
       CASE WHEN best.v IS NOT NULL THEN best.v WHEN b IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN best IS NULL THEN array_to_string(b.t, ' ') END AS mined, CASE WHEN best IS NULL THEN -b.c END AS confidence
FROM ruled LEFT JOIN matched USING (url)
"""

# --- hard negatives: every anchor against every row ------------------------------------

NEGATIVES = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v, row_number() OVER () AS r
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.r AS a, a.vec_id AS anchor_id, a.label AS own, b.r AS b, b.vec_id, b.label,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM usable a JOIN usable b ON len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT a, anchor_id, own, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE own = label AND a <> b QUALIFY place <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.a = p.a AND s.label <> p.own
WHERE 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
QUALIFY rank <= 5
"""

ORACLE_SQL = {"op2_embedding_neardup": EMBEDDINGS, "op3_secret_scans": SECRETS, "op4_url_filters": URLS,
              "op9_license_scans": LICENSES, "op13_hard_negatives": NEGATIVES}
