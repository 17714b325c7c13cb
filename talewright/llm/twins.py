"""DuckDB SQL twins of the registered queries that SQL can express."""

from __future__ import annotations

from . import url_rules
from .license_scan import oracle as license_scan

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"


def repeated_passages(min_words: int = 50) -> str:
    n = min_words
    return f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(ws[s + 1:s + {n}], ' ')) AS g
        FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - {n - 1})) AS s FROM d WHERE len(ws) >= {n})),
grp AS (SELECT g, min(doc_id) AS lo FROM win GROUP BY g HAVING min(doc_id) < max(doc_id)),
head AS (SELECT g, lo, min(s) AS head_s FROM win JOIN grp USING (g) WHERE doc_id = lo GROUP BY g, lo),
hit AS (SELECT doc_id, s, (doc_id = lo AND s = head_s) AS kept FROM win JOIN head USING (g)),
cut AS (SELECT *, CASE WHEN s - lag(s) OVER w <= {n} THEN 0 ELSE 1 END AS fresh FROM hit WINDOW w AS (PARTITION BY doc_id, kept ORDER BY s)),
isle AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, kept ORDER BY s) AS i FROM cut)
SELECT doc_id, CAST(min(s) AS BIGINT) AS start_word, CAST(max(s) + {n} AS BIGINT) AS end_word, kept
FROM isle GROUP BY doc_id, kept, i
"""


def near_duplicates(words: int = 3, percent: int = 85) -> str:
    k = words
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {k - 1}], ' ') AS g
       FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {k - 1}, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM reach r JOIN edge e ON e.a = r.doc_id),
comp AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def url_verdicts() -> str:
    rules = ", ".join(f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for v, r in url_rules.RULES)
    cut = 16        # of this SQL only: the query takes all path parts and query names
    return f"""
WITH r AS (SELECT * FROM (VALUES {rules}) t(rule, rule_host, rule_path, base)),
u AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
fit AS (SELECT page_id, arg_min(rule, (-length(rule), rule)) AS rule, arg_min(base, (-length(rule), rule)) AS base
        FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id),
parts AS (SELECT page_id, url, host, path,
          list_reverse(list_filter(string_split(host, '.'), lambda x: x <> '')) AS labels,
          list_filter(string_split(path, '/'), lambda x: x <> '')[1:{cut}] AS segs,
          string_split(regexp_extract(url, '\\?([^#]*)', 1), '&')[1:{cut}] AS qs FROM p),
tok AS (SELECT page_id, host, path, list_sort(list_distinct(list_concat(
          CASE WHEN host <> '' THEN list_concat(['s:' || split_part(url, '://', 1)],
            list_transform(range(1, greatest(len(labels), 1) + 1), lambda i: 'h' || i || ':' || coalesce(labels[i], ''))) ELSE []::VARCHAR[] END,
          list_transform(range(1, len(segs) + 1), lambda i: 'p' || i || ':' || segs[i]),
          list_filter(list_transform(qs, lambda x: 'q:' || split_part(x, '=', 1)), lambda x: x <> 'q:')))) AS tokens FROM parts),
known AS (SELECT tok.*, rule, base FROM tok LEFT JOIN fit USING (page_id)),
judged AS (SELECT tokens, base FROM known WHERE base IS NOT NULL),
total AS (SELECT count(*) AS n FROM judged),
sub AS (SELECT base, list_filter(tokens, lambda x, i: (m >> (i - 1)) & 1 = 1) AS a
        FROM (SELECT base, tokens, unnest(range(1, CAST(pow(2, len(tokens)) AS BIGINT))) AS m FROM judged)),
freq AS (SELECT a, count(*) AS c FROM sub GROUP BY a),
pair AS (SELECT a, base, count(*) AS c FROM sub GROUP BY a, base),
mined AS (SELECT a, base, pair.c / freq.c AS conf, pair.c / n AS supp FROM pair JOIN freq USING (a), total
          WHERE pair.c >= ceil({url_rules.MIN_SUPPORT} * n) AND pair.c / freq.c >= {url_rules.MIN_CONFIDENCE}),
kept AS (SELECT * FROM mined x WHERE NOT EXISTS (SELECT 1 FROM mined y WHERE y.base = x.base AND y.conf >= x.conf
         AND len(y.a) < len(x.a) AND list_has_all(x.a, y.a))),
said AS (SELECT page_id, arg_min(kept.base, (-conf, -supp, -len(a), kept.base <> 'block', kept.base)) AS says
         FROM known JOIN kept ON known.base IS NULL AND list_has_all(tokens, a) GROUP BY page_id)
SELECT known.page_id, host, path, rule, coalesce(known.base, says, '{url_rules.DEFAULT}') AS verdict
FROM known LEFT JOIN said USING (page_id)
"""


def periodic_runs(min_length: int = 6, exponent: int = 4) -> str:
    """All pairs of equal words of a document, as islands per distance."""
    crc = ("xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), "
           "lambda acc, x: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(acc, x)), "
           "CAST(4294967295 AS BIGINT)))")
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {crc} AS h FROM documents),
a AS (SELECT doc_id, w, len(w) AS n, h, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
ws AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM p),
t AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS w FROM ws),
eq AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND {exponent} * (y.i - x.i) <= x.n),
isle AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM eq),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM isle GROUP BY doc_id, q, g HAVING count(*) + q >= greatest({min_length}, {exponent} * q)),
run AS (SELECT doc_id, s, l, min(q) AS q FROM stretch GROUP BY doc_id, s, l),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l / q DESC, s, q) = 1),
said AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM run GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS collapsed FROM t
         WHERE NOT EXISTS (SELECT 1 FROM run WHERE run.doc_id = t.doc_id AND t.i >= s + q AND t.i < s + l) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, l AS length, best.q AS period, 1000 * l // best.q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN said USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def hard_negatives() -> str:
    return """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
      CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10
"""


ORACLE: dict[str, str] = {
    "op1_suffix_dedup": repeated_passages(),
    "op2_license_scan": license_scan(),
    "op6_minhash": near_duplicates(),
    "op8_url_rules": url_verdicts(),
    "op11_periodic_runs": periodic_runs(),
    "op12_hard_negatives": hard_negatives(),
    "op13_ngram_join": "SELECT * EXCLUDE (kept) FROM (" + near_duplicates(words=4) + ")",
}
