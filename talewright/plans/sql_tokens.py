"""DuckDB twins for the tokenizer queries: stories, the lookahead-free
pre-tokenizer, unrolled BPE training and encoding."""

from __future__ import annotations

from .sql_inputs import doc_split, strip

# RE2 has no lookahead: split whitespace runs before their last character
# (chr(1) marker), then use the pattern without the lookahead branch.
# Its \\s is ASCII: the white space of Unicode is spelled out.
WS = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
PRETOKEN_PATTERN_RE2 = rf"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+|[{WS}]+"""

_SQL_PATTERN = PRETOKEN_PATTERN_RE2.replace("'", "''")

STORIES = f"""
stories AS (
  SELECT doc_id, pos, story, split FROM (
    SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS pos,
      {strip('unnest(parts)')} AS story, split
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, {doc_split('doc_id')} AS split FROM documents))
  WHERE length(story) > 0
)"""

WORD_LISTS = f"""
word_lists AS (
  SELECT doc_id, pos, split, flatten(list_transform(
      string_split(regexp_replace(story, '([{WS}])([{WS}][^{WS}])', '\\1' || chr(1) || '\\2', 'g'), chr(1)),
      lambda p: regexp_extract_all(p, '{_SQL_PATTERN}'))) AS ws
  FROM stories
),
tokens AS (
  SELECT doc_id, pos, split, CAST(generate_subscripts(ws, 1) - 1 AS BIGINT) AS tpos, unnest(ws) AS word FROM word_lists
)"""

TRAIN_WORDS = """
train_words AS (
  SELECT word, CAST(sum(freq) AS BIGINT) AS freq FROM (
    SELECT word, 1 AS freq FROM tokens WHERE split = 'train'
    UNION ALL
    SELECT chr(10) AS word, 2 * (count(*) - 1) AS freq FROM stories WHERE split = 'train' HAVING count(*) > 1)
  GROUP BY word
)"""


def seg(expr: str) -> str:
    return f"regexp_replace(hex({expr}), '(..)', '<\\1>', 'g')"


def syms(expr: str) -> str:
    return f"string_split(substr({expr}, 2, length({expr}) - 2), '><')"


def bpe_rounds(vocab_size: int, min_frequency: int = 2) -> str:
    """CTEs w0 (word state), p1 (pair counts of the first round), ``merges``
    (one merge per step of a recursion over the whole word state, until the
    vocabulary has ``vocab_size`` tokens) and ``bpe_vocab``."""
    pairs = f"""SELECT syms[i] AS l, syms[i + 1] AS r, sum(freq) AS c FROM (
    SELECT freq, syms, unnest(range(1, len(syms))) AS i FROM (SELECT freq, {syms('seg')} AS syms FROM %s)) GROUP BY 1, 2"""
    return f"""w0 AS (SELECT {seg('word')} AS seg, freq FROM train_words),
alphabet AS (SELECT DISTINCT unnest({syms('seg')}) AS token FROM w0),
p1 AS ({pairs % 'w0'}),
steps AS (
  SELECT 0 AS step, seg, CAST(sum(freq) AS BIGINT) AS freq, NULL::VARCHAR AS l, NULL::VARCHAR AS r, NULL::BIGINT AS c FROM w0 GROUP BY seg
  UNION ALL
  SELECT s.step + 1, replace(s.seg, '<' || m.l || '><' || m.r || '>', '<' || m.l || m.r || '>'), s.freq, m.l, m.r, CAST(m.c AS BIGINT)
  FROM steps s, (SELECT l, r, c FROM ({pairs % 'steps'}) WHERE c >= {min_frequency} ORDER BY c DESC, l, r LIMIT 1) m
  WHERE s.step < {vocab_size} AND contains(s.seg, '><')
),
learned AS (SELECT DISTINCT step - 1 AS rank, l, r, c FROM steps WHERE step > 0),
firsts AS (SELECT l || r AS token, min(rank) AS first_rank FROM learned WHERE l || r NOT IN (SELECT token FROM alphabet) GROUP BY 1),
cut AS (SELECT coalesce(max(first_rank), -1) AS last FROM (
  SELECT first_rank FROM firsts ORDER BY first_rank LIMIT greatest(0, {vocab_size} - 4 - (SELECT count(*) FROM alphabet)))),
merges AS (SELECT rank, l, r, c FROM learned, cut
  WHERE CASE WHEN (SELECT count(*) FROM firsts) >= {vocab_size} - 4 - (SELECT count(*) FROM alphabet) THEN rank <= last ELSE true END),
bpe_vocab AS (
  SELECT * FROM (VALUES (0, '[PAD]'), (1, '[UNK]'), (2, '[BOS]'), (3, '[EOS]')) v(id, token)
  UNION ALL SELECT CAST(3 + row_number() OVER (ORDER BY token) AS INTEGER), token FROM alphabet
  UNION ALL SELECT CAST((SELECT count(*) FROM alphabet) + 3 + row_number() OVER (ORDER BY first_rank) AS INTEGER), token FROM (
    SELECT l || r AS token, min(rank) AS first_rank FROM merges GROUP BY 1) WHERE token NOT IN (SELECT token FROM alphabet)
)"""


def encode_words(table: str, word_col: str = "word") -> str:
    """Fold all merges (rank order) over distinct words of ``table``: a merge
    is the string ``<l><r>``, its result the same without the inner ``><``."""
    return f"""merge_list AS (SELECT coalesce(list('<' || l || '><' || r || '>' ORDER BY rank), []::VARCHAR[]) AS ms FROM merges),
e AS (
  SELECT word, list_reduce(list_prepend({seg('word')}, ms), lambda acc, m: replace(acc, m, replace(m, '><', ''))) AS seg
  FROM (SELECT DISTINCT {word_col} AS word FROM {table}), merge_list
),
word_ids AS (
  SELECT word, CAST(generate_subscripts(ss, 1) AS BIGINT) AS si, unnest(ss) AS sym FROM (
    SELECT word, {syms('seg')} AS ss FROM e)
),
word_ids2 AS (
  SELECT w.word, w.si, coalesce(v.id, 1) AS id FROM word_ids w LEFT JOIN bpe_vocab v ON v.token = w.sym
)"""


def pretoken_ctes(name: str, src: str, keys: str, text: str) -> str:
    """Pre-tokens of ``text`` for every row of ``src``: CTE ``{name}_tok``
    (keys..., tpos, word)."""
    return f"""
{name}_wl AS (
  SELECT {keys}, flatten(list_transform(
      string_split(regexp_replace({text}, '([{WS}])([{WS}][^{WS}])', '\\1' || chr(1) || '\\2', 'g'), chr(1)),
      lambda p: regexp_extract_all(p, '{_SQL_PATTERN}'))) AS ws
  FROM {src}
),
{name}_tok AS (
  SELECT {keys}, CAST(generate_subscripts(ws, 1) - 1 AS BIGINT) AS tpos, unnest(ws) AS word FROM {name}_wl
)"""


def sql_uniform_cols(seed_sql: str, key_sql: str) -> str:
    return (f"(('0x' || substr(md5(CAST({seed_sql} AS VARCHAR) || ':' || CAST({key_sql} AS VARCHAR)), 1, 15))"
            f"::BIGINT::DOUBLE / {float(2**60)!r})")
