"""DuckDB twins of :mod:`talewright.plans.inputs` and shared SQL fragments."""

from __future__ import annotations

from ..functions.hashing import sql_uniform
from ..functions.text import PY_WHITESPACE_CODEPOINTS
from .inputs import SPLIT_SEED, VAL_FRACTION

NL = "chr(10)"


_WS_SQL = " || ".join(f"chr({c})" for c in PY_WHITESPACE_CODEPOINTS)


def strip(expr: str) -> str:
    return f"trim({expr}, {_WS_SQL})"


def doc_split(col: str = "doc_id") -> str:
    return f"(CASE WHEN {sql_uniform(SPLIT_SEED, col)} < {VAL_FRACTION} THEN 'val' ELSE 'train' END)"


INSTRUCT_LINES = f"""
instruct_lines AS (
  SELECT 'instruct' AS src, doc_id, CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS k, unnest(ls) AS text
  FROM (
    SELECT doc_id,
      list_concat(list_concat(
        ['Features: ' || source, 'Words: ' || lang,
         'Summary: ' || string_split(text, {NL})[1], 'Story:'],
        string_split(text, {NL})), ['<|endoftext|>']) AS ls
    FROM documents)
)"""

BLOCKED_LINES = f"""
lines_stripped AS (
  SELECT src, doc_id, k, {strip('coalesce(text, ' + "''" + ')')} AS line FROM instruct_lines
),
blocked AS (
  SELECT src, doc_id, k, line,
    CAST(coalesce(sum(CASE WHEN line = '<|endoftext|>' THEN 1 ELSE 0 END) OVER (
      PARTITION BY src ORDER BY doc_id, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS block
  FROM lines_stripped
)"""

CLASSIFIED = f"""
classified AS (
  SELECT src, block, doc_id, k, line,
    CASE WHEN starts_with(lower(line), 'features:') THEN 'features'
         WHEN starts_with(lower(line), 'words:') THEN 'words'
         WHEN starts_with(lower(line), 'summary:') THEN 'summary'
         WHEN starts_with(lower(line), 'story:') THEN 'story'
         ELSE 'text' END AS ctype,
    CASE WHEN starts_with(lower(line), 'features:') THEN {strip('substr(line, 10)')}
         WHEN starts_with(lower(line), 'words:') THEN {strip('substr(line, 7)')}
         WHEN starts_with(lower(line), 'summary:') THEN {strip('substr(line, 9)')}
         WHEN starts_with(lower(line), 'story:') THEN {strip('substr(line, 7)')}
         ELSE line END AS cval
  FROM blocked WHERE line <> '<|endoftext|>'
)"""

RECORDS = """
first_story AS (
  SELECT src, block, min(doc_id * 1000000000 + k) AS fs FROM classified
  WHERE ctype = 'story' AND line <> '' GROUP BY src, block
),
records AS (
  SELECT c.src, c.block, min(c.doc_id) AS first_doc,
    string_agg(CASE c.ctype WHEN 'features' THEN 'with features: ' || c.cval
                            WHEN 'words' THEN 'using the words: ' || c.cval
                            WHEN 'summary' THEN 'about: ' || c.cval END, ', ' ORDER BY c.doc_id, c.k) AS parts,
    string_agg(CASE WHEN (c.ctype = 'story' AND c.cval <> '')
                      OR (c.ctype = 'text' AND c.doc_id * 1000000000 + c.k > f.fs) THEN c.cval END,
               ' ' ORDER BY c.doc_id, c.k) AS response
  FROM classified c LEFT JOIN first_story f ON c.src = f.src AND c.block = f.block
  WHERE c.line <> ''
  GROUP BY c.src, c.block
),
assembled AS (
  SELECT src, block, first_doc,
    CASE WHEN parts IS NULL THEN 'Write a short story.' ELSE 'Write a short story ' || parts || '.' END AS prompt,
    response
  FROM records WHERE response IS NOT NULL AND length(response) >= 40
)"""
