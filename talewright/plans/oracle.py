"""DuckDB twins of the registered queries (same column names)."""

from __future__ import annotations

from ..functions.text import INCOMPLETE_UTF8_TAIL_HEX
from .sql_inputs import BLOCKED_LINES, CLASSIFIED, INSTRUCT_LINES, RECORDS, doc_split, strip
from .sql_tokens import (STORIES, TRAIN_WORDS, WORD_LISTS, bpe_rounds, encode_words, pretoken_ctes, seg,
                         sql_uniform_cols)

ORACLE: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


_BLOCKS = _with(INSTRUCT_LINES, BLOCKED_LINES)
_CLASS = _with(INSTRUCT_LINES, BLOCKED_LINES, CLASSIFIED)
_RECS = _with(INSTRUCT_LINES, BLOCKED_LINES, CLASSIFIED, RECORDS)

ORACLE["block_ids"] = _BLOCKS + """
SELECT doc_id, k, block FROM blocked WHERE line <> '<|endoftext|>'"""

ORACLE["classify_lines"] = _CLASS + """
SELECT doc_id, k, ctype, cval FROM classified"""

ORACLE["in_story_flag"] = _CLASS + """,
fs AS (SELECT src, block, min(doc_id * 1000000000 + k) AS fs FROM classified WHERE ctype = 'story' GROUP BY ALL)
SELECT c.doc_id, c.k, coalesce(c.doc_id * 1000000000 + c.k >= fs.fs, false) AS in_story
FROM classified c LEFT JOIN fs ON c.src = fs.src AND c.block = fs.block"""

ORACLE["assemble_records"] = _RECS + """
SELECT block, prompt, response FROM assembled"""

ORACLE["build_prompt"] = _CLASS + """
SELECT block,
  CASE WHEN parts IS NULL THEN 'Write a short story.' ELSE 'Write a short story ' || parts || '.' END AS prompt
FROM (
  SELECT block,
    string_agg(CASE ctype WHEN 'features' THEN 'with features: ' || cval
                          WHEN 'words' THEN 'using the words: ' || cval
                          WHEN 'summary' THEN 'about: ' || cval END, ', ' ORDER BY doc_id, k) AS parts
  FROM classified WHERE line <> '' GROUP BY block)"""

_CHAT = """
WITH chat AS (
  SELECT conv_id, turn, prompt, response FROM (
    SELECT conv_id, turn, role, text AS response, lag(text) OVER w AS prompt, lag(role) OVER w AS before
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'assistant' AND before = 'user'
)"""

ORACLE["chat_pairs"] = _CHAT + "\nSELECT conv_id, turn, prompt, response FROM chat"

ORACLE["full_text"] = _CHAT + """
SELECT conv_id, turn, prompt || chr(10) || chr(10) AS prompt_text,
  prompt || chr(10) || chr(10) || response AS full_text FROM chat"""

ORACLE["valid_records"] = _CHAT + """
SELECT CAST(count(*) AS BIGINT) AS processed,
  CAST(count(*) FILTER (WHERE coalesce(length(prompt), 0) > 0 AND coalesce(length(response), 0) > 0) AS BIGINT) AS written,
  CAST(count(*) FILTER (WHERE NOT (coalesce(length(prompt), 0) > 0 AND coalesce(length(response), 0) > 0)) AS BIGINT) AS skipped
FROM chat"""

# ---------------------------------------------------------------- sources, order, projections

_JSON_DOCS = """
json_docs AS (
  SELECT doc_id,
    CASE lang WHEN 'en' THEN to_json({'text': text})::VARCHAR
              WHEN 'fr' THEN to_json({'story': text, 'other': 1})::VARCHAR
              WHEN 'de' THEN to_json(string_split(text, chr(10)))::VARCHAR
              ELSE '[' || to_json({'text': '', 'story': text})::VARCHAR || ',' || to_json({'story': text})::VARCHAR || ']' END AS js
  FROM documents
),
json_items AS (
  SELECT doc_id, CAST(0 AS BIGINT) AS item_pos, js::JSON AS item FROM json_docs WHERE json_type(js::JSON) = 'OBJECT'
  UNION ALL
  SELECT doc_id, CAST(generate_subscripts(items, 1) - 1 AS BIGINT) AS item_pos, unnest(items) AS item
  FROM (SELECT doc_id, json_extract(js::JSON, '$[*]') AS items FROM json_docs WHERE json_type(js::JSON) = 'ARRAY')
),
json_text AS (
  SELECT doc_id, item_pos,
    CASE WHEN json_type(item) = 'VARCHAR' THEN """ + strip("json_extract_string(item, '$')") + """
         WHEN json_type(item) = 'OBJECT' THEN (
           CASE WHEN json_type(t) = 'VARCHAR' AND length(json_extract_string(t, '$')) > 0
                THEN json_extract_string(t, '$') END)
    END AS story
  FROM (SELECT *, CASE WHEN json_type(item) = 'OBJECT' THEN
          coalesce(json_extract(item, '$.text'), json_extract(item, '$.story')) END AS t FROM json_items)
),
json_stories AS (SELECT doc_id, item_pos, story FROM json_text WHERE story IS NOT NULL AND length(story) > 0)"""

_SPLIT_DOCS = """
split_docs AS (
  SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS pos, unnest(parts) AS piece
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
),
doc_stories AS (
  SELECT doc_id, pos, """ + strip("piece") + """ AS story FROM split_docs
)"""

ORACLE["split_stories"] = "WITH " + _SPLIT_DOCS + "\nSELECT doc_id, pos, story FROM doc_stories WHERE length(story) > 0"

ORACLE["min_length"] = "WITH " + _SPLIT_DOCS + "\nSELECT doc_id, pos, story FROM doc_stories WHERE length(story) >= 40"

ORACLE["json_stories"] = "WITH " + _JSON_DOCS + "\nSELECT doc_id, item_pos, story FROM json_stories"

def _routed(key: str) -> str:
    """Split by the hashed file name: its first hex digit below 6 or from 10 to
    11 names train, 6 to 9 val alone."""
    digit = f"substr(md5(CAST({key} AS VARCHAR)), 1, 1)"
    return f"CASE WHEN {digit} IN ('0', '1', '2', '3', '4', '5', 'a', 'b') THEN 'train' WHEN {digit} IN ('6', '7', '8', '9') THEN 'val' END"


ORACLE["format_fallback"] = "WITH " + _JSON_DOCS + """,
routed AS (
  SELECT doc_id, text, """ + _routed("doc_id") + """ AS split FROM documents
),
primary_rows AS (
  SELECT split, doc_id, item_pos, story FROM (
    SELECT split, doc_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS item_pos,
      """ + strip("unnest(parts)") + """ AS story
    FROM (SELECT split, doc_id, string_split(text, chr(10)) AS parts FROM routed WHERE split = 'val'))
  WHERE length(story) > 0
)
SELECT * FROM primary_rows
UNION ALL
SELECT """ + doc_split("doc_id") + """ AS split, doc_id, item_pos, story FROM json_stories
WHERE NOT EXISTS (SELECT 1 FROM primary_rows WHERE split = 'train')"""

ORACLE["route_split"] = """
SELECT page_id, split FROM (SELECT page_id, """ + _routed("page_id") + """ AS split FROM pages) WHERE split IS NOT NULL"""

ORACLE["byte_budget"] = """
WITH s AS (
  SELECT source, doc_id, text,
    coalesce(sum(strlen(text) + 2) OVER (PARTITION BY source ORDER BY doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM documents
),
c AS (
  SELECT source, doc_id, """ + strip(
    "CASE WHEN strlen(text) <= 65536 - start THEN text ELSE decode(unhex(regexp_replace("
    "hex(text)[1:CAST(2 * (65536 - start) AS BIGINT)], '" + INCOMPLETE_UTF8_TAIL_HEX + "', ''))) END") + """ AS text
  FROM s WHERE start < 65536
)
SELECT source, doc_id, text FROM c WHERE length(text) > 0"""

ORACLE["per_source_cap"] = """
SELECT source, doc_id, rank FROM (
  SELECT source, doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS BIGINT) AS rank FROM documents)
WHERE rank <= 20"""

ORACLE["fill_order_split"] = """
SELECT doc_id, CASE WHEN i < 600 THEN 'train' ELSE 'val' END AS split FROM (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)
WHERE i < 800"""

ORACLE["ordered_index"] = """
SELECT doc_id, lang, CAST(row_number() OVER (ORDER BY lang, doc_id) - 1 AS BIGINT) AS idx FROM documents"""

ORACLE["strip_nonempty"] = """
SELECT conv_id, turn, pos, line FROM (
  SELECT conv_id, turn, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS pos, """ + strip("unnest(parts)") + """ AS line
  FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS parts FROM conversations))
WHERE length(line) > 0"""

ORACLE["default_key"] = """
SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k,
  coalesce(json_extract_string(props, '$.text'), '') AS text FROM events"""

ORACLE["sample_n"] = _CHAT + """
SELECT conv_id, turn, sample_rank FROM (
  SELECT conv_id, turn, CAST(CASE WHEN n > 100 THEN hr ELSE orank END AS BIGINT) AS sample_rank FROM (
    SELECT conv_id, turn, count(*) OVER () AS n,
      row_number() OVER (ORDER BY md5('1337:' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)), conv_id, turn) - 1 AS hr,
      row_number() OVER (ORDER BY conv_id, turn) - 1 AS orank
    FROM chat))
WHERE sample_rank < 100"""

ORACLE["ratio_split"] = _RECS + """
SELECT block, CASE WHEN i < floor(n * 0.9) THEN 'train'
                   WHEN i < floor(n * 0.9) + floor((n - floor(n * 0.9)) * (1 - 0.05 / (0.05 + 0.05))) THEN 'test'
                   ELSE 'holdout_test' END AS split
FROM (SELECT block, row_number() OVER (ORDER BY block) - 1 AS i, count(*) OVER () AS n FROM assembled)"""

ORACLE["round_robin"] = """
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents),
p AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS p, count(*) OVER () AS n FROM benchmark)
SELECT d.doc_id, p.item_id FROM d JOIN p ON p.p = d.i % p.n"""

# ---------------------------------------------------------------- tokenizers

_TOK = "WITH RECURSIVE " + STORIES + "," + WORD_LISTS
_TRAIN = _TOK + "," + TRAIN_WORDS
_BPE = _TRAIN + ",\n" + bpe_rounds(256)

_CHARS = STORIES + """,
char_vocab AS (
  SELECT CAST(row_number() OVER (ORDER BY token) - 1 AS INTEGER) AS id, token FROM (
    SELECT DISTINCT unnest(regexp_extract_all(story, '(?s).')) AS token FROM stories WHERE split = 'train'
    UNION SELECT chr(10))
),
all_story_chars AS (
  SELECT doc_id, pos, CAST(generate_subscripts(cs, 1) AS BIGINT) AS ci, unnest(cs) AS ch FROM (
    SELECT doc_id, pos, regexp_extract_all(story, '(?s).') AS cs FROM stories)
)"""

ORACLE["char_vocab"] = "WITH " + _CHARS + "\nSELECT id, token FROM char_vocab"

ORACLE["char_encode"] = "WITH " + _CHARS + """
SELECT doc_id, pos, coalesce(string_agg(CAST(v.id AS VARCHAR), ',' ORDER BY ci), '') AS ids,
  CAST(count(*) FILTER (WHERE v.id IS NULL) AS BIGINT) AS n_oov
FROM all_story_chars c LEFT JOIN char_vocab v ON v.token = c.ch GROUP BY doc_id, pos"""

ORACLE["char_decode"] = "WITH " + _CHARS + """
SELECT doc_id, pos, coalesce(string_agg(coalesce(v.token, chr(65533)), '' ORDER BY ci), '') AS text
FROM all_story_chars c LEFT JOIN char_vocab v ON v.token = c.ch GROUP BY doc_id, pos"""

ORACLE["pretokenize"] = _TOK + "\nSELECT doc_id, pos, tpos, word FROM tokens"

ORACLE["word_counts"] = _TRAIN + "\nSELECT word, freq FROM train_words"

ORACLE["byte_symbols"] = _TRAIN + f"\nSELECT word, {seg('word')} AS seg FROM train_words"

ORACLE["pair_counts"] = _BPE + "\nSELECT l AS left_tok, r AS right_tok, CAST(c AS BIGINT) AS count FROM p1"

ORACLE["bpe_train"] = _BPE + "\nSELECT CAST(rank AS BIGINT) AS rank, l AS left_tok, r AS right_tok, CAST(c AS BIGINT) AS count FROM merges"

ORACLE["special_tokens"] = _BPE + "\nSELECT CAST(id AS BIGINT) AS id, token FROM bpe_vocab"

_BPE_ENC = _BPE + ",\n" + encode_words("tokens") + """,
story_ids AS (
  SELECT t.doc_id, t.pos, t.split,
    '2,' || string_agg(CAST(w.id AS VARCHAR), ',' ORDER BY t.tpos, w.si) || ',3' AS ids,
    count(*) + 2 AS n_ids
  FROM tokens t JOIN word_ids2 w ON w.word = t.word GROUP BY t.doc_id, t.pos, t.split
)"""

ORACLE["bpe_encode"] = _BPE_ENC + "\nSELECT doc_id, pos, ids FROM story_ids"

ORACLE["token_stats"] = _BPE_ENC + """
SELECT 'char' AS tokenizer, CAST(count(*) AS BIGINT) AS n_texts, CAST(sum(length(story)) AS BIGINT) AS n_tokens,
  round(avg(length(story)), 6) AS avg_tokens FROM stories
UNION ALL
SELECT 'bpe', CAST(count(*) AS BIGINT), CAST(sum(n_ids) AS BIGINT), round(avg(n_ids), 6) FROM story_ids"""

# ---------------------------------------------------------------- streams, n-gram model, evaluation

_STREAM_CTES = _CHARS + """,
all_chars AS (
  SELECT split, doc_id, pos, CAST(generate_subscripts(cs, 1) AS BIGINT) AS ci, unnest(cs) AS ch FROM (
    SELECT split, doc_id, pos, regexp_extract_all(story, '(?s).') AS cs FROM stories)
),
last_story AS (
  SELECT split, doc_id, pos FROM (
    SELECT split, doc_id, pos, row_number() OVER (PARTITION BY split ORDER BY doc_id DESC, pos DESC) AS rn FROM stories)
  WHERE rn = 1
),
stream AS (
  SELECT c.split, c.doc_id, c.pos, c.ci, coalesce(v.id, CAST((SELECT count(*) FROM char_vocab) AS INTEGER)) AS token
  FROM all_chars c LEFT JOIN char_vocab v ON v.token = c.ch
  UNION ALL
  SELECT s.split, s.doc_id, s.pos, 1000000000 + j.j, (SELECT id FROM char_vocab WHERE token = chr(10))
  FROM stories s, (VALUES (1), (2)) j(j)
  WHERE NOT EXISTS (SELECT 1 FROM last_story l WHERE l.split = s.split AND l.doc_id = s.doc_id AND l.pos = s.pos)
),
positions AS (
  SELECT split, CAST(row_number() OVER (PARTITION BY split ORDER BY doc_id, pos, ci) - 1 AS BIGINT) AS gpos, token FROM stream
),
pairs AS (
  SELECT split, gpos, token, next_token FROM (
    SELECT split, gpos, token, lead(token) OVER (PARTITION BY split ORDER BY gpos) AS next_token FROM positions)
  WHERE next_token IS NOT NULL
),
vsize AS (SELECT count(*) + 1 AS v FROM char_vocab),
counts AS (SELECT token, next_token, count(*) AS c FROM pairs WHERE split = 'train' GROUP BY ALL),
ctx AS (
  SELECT token, tot, next_token AS pred FROM (
    SELECT token, next_token, sum(c) OVER (PARTITION BY token) AS tot,
      row_number() OVER (PARTITION BY token ORDER BY c DESC, next_token) AS rn FROM counts)
  WHERE rn = 1
),
model AS (
  SELECT c.token, c.next_token, c.c, x.tot, x.pred, ln((c.c + 1.0) / (x.tot + 1.0 * (SELECT v FROM vsize))) AS logprob
  FROM counts c JOIN ctx x USING (token)
)"""

_STREAM = "WITH " + _STREAM_CTES


def _score(src: str) -> str:
    return f"""SELECT w.*, -ln((coalesce(m.c, 0) + 1.0) / (coalesce(x.tot, 0) + 1.0 * (SELECT v FROM vsize))) AS nll,
      CAST(coalesce(x.pred, 0) = w.next_token AS INTEGER) AS correct
    FROM {src} w LEFT JOIN counts m ON m.token = w.token AND m.next_token = w.next_token
    LEFT JOIN ctx x ON x.token = w.token"""


ORACLE["pack_stream"] = _STREAM + """
SELECT split, gpos // 4096 AS block_id, CAST(count(*) AS BIGINT) AS n_tokens,
  string_agg(CAST(token AS VARCHAR), ',' ORDER BY gpos) AS ids
FROM positions GROUP BY ALL"""

ORACLE["next_token_pairs"] = _STREAM + "\nSELECT split, gpos, token, next_token FROM pairs"

ORACLE["ngram_fit"] = _STREAM + "\nSELECT token, next_token, CAST(c AS BIGINT) AS count, round(logprob, 6) AS logprob FROM model"

ORACLE["ngram_score"] = _STREAM + """,
vm AS (SELECT token, next_token, count(*) AS n FROM pairs WHERE split = 'val' GROUP BY ALL),
sc AS (""" + _score("vm") + """)
SELECT token, next_token, CAST(n AS BIGINT) AS n, round(nll, 6) AS nll, correct FROM sc"""

ORACLE["ngram_eval"] = _STREAM + """,
sc AS (""" + _score("pairs") + """)
SELECT split, CAST(count(*) AS BIGINT) AS n_tokens, round(avg(nll), 6) AS loss, round(exp(avg(nll)), 6) AS perplexity,
  round(avg(nll) / ln(2), 6) AS bpc, round(avg(correct), 6) AS top1_accuracy
FROM sc GROUP BY split"""

ORACLE["bits_per_char"] = _STREAM + """,
sc AS (""" + _score("pairs") + """)
SELECT split, round(sum(nll) / (ln(2) * sum(coalesce(length(v.token), 1))), 6) AS bits_per_char, CAST(sum(coalesce(length(v.token), 1)) AS BIGINT) AS chars
FROM sc LEFT JOIN char_vocab v ON v.id = sc.next_token GROUP BY split"""

_EVAL = _STREAM + """,
runs AS (
  SELECT unnest(list_transform(list_filter(list_transform(string_split('1337, 42,,7', ','), lambda x: trim(x)),
                                           lambda x: x <> ''), lambda x: CAST(x AS INTEGER))) AS seed
),
draws AS (
  SELECT r.seed, s.split, d.draw, d.draw // 32 AS batch
  FROM runs r, (VALUES ('train'), ('val')) s(split), range(0, 6400) d(draw)
),
sizes AS (SELECT split, count(*) AS n FROM positions GROUP BY split),
starts AS (
  SELECT d.*, CAST(floor(""" + sql_uniform_cols("d.seed", "d.draw") + """ * (z.n - 128)) AS BIGINT) AS start
  FROM draws d JOIN sizes z USING (split)
),
win_pairs AS (
  SELECT s.seed, s.split, s.batch, s.draw, s.start, s.i, p.token, p.next_token
  FROM (SELECT *, unnest(range(128)) AS i FROM starts) s JOIN pairs p ON p.split = s.split AND p.gpos = s.start + s.i
),
scored AS (""" + _score("win_pairs") + """),
batches AS (SELECT seed, split, batch, avg(nll) AS bl FROM scored GROUP BY ALL),
report AS (
  SELECT b.seed, b.split, count(*) AS n_batches, avg(bl) AS loss,
    (SELECT count(*) FROM scored s WHERE s.seed = b.seed AND s.split = b.split) AS n_tokens,
    (SELECT avg(correct) FROM scored s WHERE s.seed = b.seed AND s.split = b.split) AS top1_accuracy
  FROM batches b GROUP BY b.seed, b.split
)"""

ORACLE["window_batch"] = _EVAL + """
SELECT seed, split, CAST(batch AS BIGINT) AS batch, draw, start, string_agg(CAST(token AS VARCHAR), ',' ORDER BY i) AS x,
  string_agg(CAST(next_token AS VARCHAR), ',' ORDER BY i) AS y
FROM win_pairs GROUP BY ALL"""

# the score table holds every token after every context
_SCORES = """,
ids AS (SELECT CAST(unnest(range(0, (SELECT v FROM vsize))) AS INTEGER) AS id),
score_table AS (
  SELECT a.id AS token, b.id AS next_token, ln((coalesce(c.c, 0) + 1.0) / (coalesce(x.tot, 0) + 1.0 * (SELECT v FROM vsize))) AS logprob
  FROM ids a CROSS JOIN ids b LEFT JOIN counts c ON c.token = a.id AND c.next_token = b.id LEFT JOIN ctx x ON x.token = a.id
)"""

ORACLE["token_nll"] = _EVAL + _SCORES + """,
lse AS (
  SELECT token, mx + ln(sum(exp(logprob - mx))) AS lse FROM (
    SELECT token, logprob, max(logprob) OVER (PARTITION BY token) AS mx FROM score_table) GROUP BY token, mx
),
each_nll AS (
  SELECT w.seed, w.split, w.draw, l.lse - m.logprob AS nll FROM win_pairs w LEFT JOIN lse l ON l.token = w.token
  LEFT JOIN score_table m ON m.token = w.token AND m.next_token = w.next_token
)
SELECT seed, split, draw, count(nll) AS n_tokens, round(sum(nll), 6) AS nll_sum, round(min(nll), 6) AS nll_min, round(max(nll), 6) AS nll_max
FROM each_nll GROUP BY ALL"""

ORACLE["mean_batch_loss"] = _EVAL + """
SELECT seed, split, CAST(n_batches AS BIGINT) AS n_batches, round(loss, 6) AS loss FROM report"""

ORACLE["loss_metrics"] = _EVAL + """
SELECT seed, split, round(loss, 6) AS loss, round(exp(loss), 6) AS perplexity, round(loss / ln(2), 6) AS bpc FROM report"""

ORACLE["top1_accuracy"] = _EVAL + """
SELECT w.seed, w.split, CAST(count(*) AS BIGINT) AS total,
  round(sum(CASE WHEN coalesce(x.pred, 0) = w.next_token THEN 1 ELSE 0 END) / count(*), 6) AS top1_accuracy
FROM win_pairs w LEFT JOIN ctx x ON x.token = w.token GROUP BY w.seed, w.split"""

ORACLE["eval_report"] = _EVAL + """
SELECT seed, split, CAST(n_batches AS BIGINT) AS n_batches, CAST(n_tokens AS BIGINT) AS n_tokens,
  round(loss, 6) AS loss, round(exp(loss), 6) AS perplexity, round(loss / ln(2), 6) AS bpc,
  round(top1_accuracy, 6) AS top1_accuracy
FROM report"""

ORACLE["seed_stability"] = _EVAL + """
SELECT CAST(count(*) AS BIGINT) AS num_runs, round(avg(loss), 6) AS val_loss_mean, round(stddev_pop(loss), 6) AS val_loss_std,
  round(avg(exp(loss)), 6) AS val_ppl_mean, round(stddev_pop(exp(loss)), 6) AS val_ppl_std
FROM report WHERE split = 'val'"""

ORACLE["sweep_grid"] = _EVAL + """
SELECT r.seed, CAST(NULL AS INTEGER) AS d_model, CAST(NULL AS INTEGER) AS context_length, round(p.loss, 6) AS val_loss
FROM runs r LEFT JOIN report p ON p.seed = r.seed AND p.split = 'val'"""

ORACLE["config_override"] = _EVAL + """
SELECT r.seed, CAST(96 AS BIGINT) AS d_model, CAST(128 AS BIGINT) AS context_length, CAST(32 AS BIGINT) AS batch_size,
  CAST(200 AS BIGINT) AS eval_iters, (SELECT CAST(count(*) AS BIGINT) FROM starts s WHERE s.seed = r.seed) AS windows
FROM runs r"""

ORACLE["throughput"] = """
SELECT event_type, CAST(count(*) AS BIGINT) AS tokens, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS seconds,
  round(CASE WHEN epoch_us(max(ts)) - epoch_us(min(ts)) > 0
             THEN count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) ELSE 0.0 END, 6) AS tokens_per_sec
FROM events GROUP BY event_type"""

_LOG = "WITH log AS (SELECT event_type AS run, event_id AS step, value AS val_loss, ts FROM events)"

ORACLE["best_so_far"] = _LOG + """
SELECT run, step, val_loss, best_before, best_before IS NULL OR val_loss < best_before AS is_best FROM (
  SELECT run, step, val_loss, min(val_loss) OVER (PARTITION BY run ORDER BY step
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM log)"""

ORACLE["eval_points"] = _LOG + """
SELECT run, step FROM (SELECT run, step, max(step) OVER (PARTITION BY run) AS last FROM log)
WHERE step % 500 = 0 OR step = last"""

_DAILY = _LOG + """,
daily AS (SELECT run, CAST(ts AS DATE) AS day, avg(val_loss) AS val_loss FROM log GROUP BY ALL)"""

ORACLE["run_delta"] = _DAILY + """
SELECT run, CAST(day AS VARCHAR) AS day, round(val_loss, 6) AS val_loss,
  round(val_loss - lag(val_loss) OVER (PARTITION BY run ORDER BY day), 6) AS val_loss_delta FROM daily"""

ORACLE["compare_runs"] = _DAILY + """
SELECT CAST(day AS VARCHAR) AS day, run, v AS val_loss, row_number() OVER w AS rank, first_value(run) OVER w AS winner
FROM (SELECT run, day, round(val_loss, 6) AS v FROM daily) WINDOW w AS (PARTITION BY day ORDER BY v, run)"""

ORACLE["best_checkpoint"] = _LOG + """
SELECT run, step AS best_step, val_loss AS best_loss FROM (
  SELECT run, step, val_loss, row_number() OVER (PARTITION BY run ORDER BY val_loss, step) AS rn FROM log)
WHERE rn = 1"""

_PROMPTS = _STREAM + _SCORES + """,
item_chars AS (
  SELECT ctx_id, CAST(generate_subscripts(cs, 1) AS BIGINT) AS ci, unnest(cs) AS ch FROM (
    SELECT item_id AS ctx_id, regexp_extract_all(text, '(?s).') AS cs FROM benchmark)
),
item_ids AS (SELECT ic.ctx_id, ic.ci, coalesce(v.id, CAST((SELECT count(*) FROM char_vocab) AS INTEGER)) AS id
  FROM item_chars ic LEFT JOIN char_vocab v ON v.token = ic.ch),
ctx_last AS (SELECT ctx_id, arg_max(id, ci) AS last FROM item_ids GROUP BY ctx_id),
pscores AS (SELECT l.ctx_id, m.next_token AS token_id, m.logprob AS logit FROM ctx_last l JOIN score_table m ON m.token = l.last),
hist AS (SELECT DISTINCT ctx_id, id AS token_id FROM item_ids),
penalized AS (
  SELECT p.ctx_id, p.token_id, CASE WHEN h.token_id IS NOT NULL THEN p.logit / 1.3 ELSE p.logit END AS logit
  FROM pscores p LEFT JOIN hist h ON h.ctx_id = p.ctx_id AND h.token_id = p.token_id
)"""

ORACLE["seen_penalty"] = _PROMPTS + "\nSELECT ctx_id, token_id, round(logit, 6) AS logit FROM penalized"

ORACLE["top_k_filter"] = _PROMPTS + """
SELECT ctx_id, token_id, round(logit, 6) AS logit, rank() OVER (PARTITION BY ctx_id ORDER BY logit DESC) <= 5 AS kept
FROM pscores"""

ORACLE["sample_next"] = _PROMPTS + """,
t AS (
  SELECT p.ctx_id, p.token_id, CASE WHEN h.token_id IS NOT NULL THEN (p.logit / 0.8) / 1.3 ELSE p.logit / 0.8 END AS logit
  FROM pscores p LEFT JOIN hist h ON h.ctx_id = p.ctx_id AND h.token_id = p.token_id
),
k AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY ctx_id ORDER BY logit DESC) AS rk FROM t) WHERE rk <= 20),
pr AS (SELECT ctx_id, token_id, exp(logit - max(logit) OVER (PARTITION BY ctx_id)) AS e FROM k),
cu AS (
  SELECT ctx_id, token_id, sum(e / tot) OVER (PARTITION BY ctx_id ORDER BY token_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM (SELECT *, sum(e) OVER (PARTITION BY ctx_id) AS tot FROM pr)
)
SELECT ctx_id, coalesce(min(CASE WHEN cum > """ + sql_uniform_cols("1337", "ctx_id") + """ THEN token_id END), max(token_id)) AS token_id
FROM cu GROUP BY ctx_id"""

ORACLE["oov_tokens"] = _STREAM + """,
english AS (
  SELECT DISTINCT ch FROM all_chars JOIN documents USING (doc_id) WHERE split = 'train' AND lang = 'en' UNION SELECT chr(10)
)
SELECT ch AS token, CAST(count(*) AS BIGINT) AS n FROM all_chars
WHERE split = 'val' AND ch NOT IN (SELECT ch FROM english) GROUP BY ch"""

ORACLE["corpus_profile"] = _RECS + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM instruct_lines) AS raw_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM assembled) AS records, CAST(3 AS BIGINT) AS n_columns"""

ORACLE["prompt_diversity"] = _RECS + "\nSELECT CAST(count(DISTINCT prompt) AS BIGINT) AS unique_prompts FROM assembled"

# ---------------------------------------------------------------- SFT samples
_SFT = _BPE + """,
chat AS (
  SELECT conv_id, turn, prompt, response FROM (
    SELECT conv_id, turn, role, text AS response, lag(text) OVER w AS prompt, lag(role) OVER w AS before
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'assistant' AND before = 'user'
),
recs AS (
  SELECT conv_id, turn, prompt || chr(10) || chr(10) AS prompt_text, prompt || chr(10) || chr(10) || response AS full_text,
    CASE WHEN i < floor(n * 0.9) THEN 'train'
         WHEN i < floor(n * 0.9) + floor((n - floor(n * 0.9)) * (1 - 0.05 / (0.05 + 0.05))) THEN 'test'
         ELSE 'holdout_test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS i, count(*) OVER () AS n FROM chat)
),""" + pretoken_ctes("sp", "recs", "conv_id, turn", "prompt_text") + "," + pretoken_ctes("sf", "recs", "conv_id, turn", "full_text") + ",\n" + encode_words("(SELECT word FROM sp_tok UNION SELECT word FROM sf_tok)") + """,
full_ids AS (
  SELECT t.conv_id, t.turn, list_concat(list_concat([2], list(w.id ORDER BY t.tpos, w.si)), [3]) AS f
  FROM sf_tok t JOIN word_ids2 w ON w.word = t.word GROUP BY t.conv_id, t.turn
),
prompt_len AS (
  SELECT t.conv_id, t.turn, count(*) + 2 AS p FROM sp_tok t JOIN word_ids2 w ON w.word = t.word GROUP BY t.conv_id, t.turn
),
trip AS (
  SELECT r.conv_id, r.turn, r.split, len(f.f) AS full_len, p.p AS prompt_len, least(len(f.f), 256) AS l,
    list_resize(f.f[1:256], 256, 0) AS tokens,
    list_resize(list_concat(f.f[1:256][2:], [0]), 256, 0) AS targets,
    list_transform(range(256), lambda i: CASE WHEN i >= greatest(0, p.p - 1) AND i < least(len(f.f), 256) - 1 THEN 1 ELSE 0 END) AS mask
  FROM recs r JOIN full_ids f USING (conv_id, turn) JOIN prompt_len p USING (conv_id, turn)
)"""

ORACLE["sft_triplets"] = _SFT + """
SELECT conv_id, turn, split, CAST(full_len AS BIGINT) AS full_len, CAST(prompt_len AS BIGINT) AS prompt_len,
  array_to_string(tokens, ',') AS tokens, array_to_string(targets, ',') AS targets, array_to_string(mask, ',') AS mask
FROM trip"""

ORACLE["truncate_pad"] = _SFT + "\nSELECT conv_id, turn, array_to_string(tokens, ',') AS tokens FROM trip"

ORACLE["shift_targets"] = _SFT + "\nSELECT conv_id, turn, array_to_string(targets, ',') AS targets FROM trip"

ORACLE["loss_mask"] = _SFT + "\nSELECT conv_id, turn, array_to_string(mask, ',') AS mask FROM trip"

ORACLE["mask_coverage"] = _SFT + """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE full_len > 256) AS BIGINT) AS truncated,
  CAST(count(*) FILTER (WHERE list_sum(mask) = 0) AS BIGINT) AS all_zero_mask,
  CAST(sum(list_sum(mask)) AS BIGINT) AS response_tokens
FROM trip"""

ORACLE["masked_loss"] = _SFT + """,
tpos AS (
  SELECT conv_id, turn, split, l, CAST(generate_subscripts(tokens, 1) - 1 AS BIGINT) AS i,
    unnest(tokens) AS token, unnest(targets) AS next_token, unnest(mask) AS m
  FROM trip
),
sc AS (SELECT token, next_token, count(*) AS c FROM tpos WHERE split = 'train' AND i < l - 1 GROUP BY ALL),
sx AS (SELECT token, sum(c) AS tot FROM sc GROUP BY token),
nv AS (SELECT count(*) AS v FROM bpe_vocab),
per AS (
  SELECT p.conv_id, p.turn,
    sum(-ln((coalesce(c.c, 0) + 1.0) / (coalesce(x.tot, 0) + 1.0 * (SELECT v FROM nv)))) AS num, count(*) AS den
  FROM tpos p LEFT JOIN sc c ON c.token = p.token AND c.next_token = p.next_token LEFT JOIN sx x ON x.token = p.token
  WHERE p.m > 0 GROUP BY p.conv_id, p.turn
)
SELECT t.conv_id, t.turn, round(coalesce(per.num, 0.0) / greatest(coalesce(per.den, 0), 1.0), 6) AS masked_loss
FROM trip t LEFT JOIN per USING (conv_id, turn)"""

ORACLE["record_batch"] = _SFT + """,
tr AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx, count(*) OVER () AS n FROM recs WHERE split = 'train'),
dr AS (SELECT d.draw, CAST(floor(""" + sql_uniform_cols("1337", "d.draw") + """ * (SELECT max(n) FROM tr)) AS BIGINT) AS idx FROM range(0, 16) d(draw))
SELECT dr.draw, tr.conv_id, tr.turn FROM dr JOIN tr USING (idx)"""

# ---------------------------------------------------------------- file round trips
ORACLE["sft_records"] = _CHAT + """,
recs AS (
  SELECT prompt, response,
    CASE WHEN i < floor(n * 0.9) THEN 'train'
         WHEN i < floor(n * 0.9) + floor((n - floor(n * 0.9)) * (1 - 0.05 / (0.05 + 0.05))) THEN 'test'
         ELSE 'holdout_test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS i, count(*) OVER () AS n FROM chat)
)
SELECT split, prompt, response FROM recs WHERE coalesce(length(prompt), 0) > 0 AND coalesce(length(response), 0) > 0"""

ORACLE["benchmark_log"] = _EVAL + """
SELECT t.seed, (SELECT CAST(count(*) AS BIGINT) FROM model) AS params,
  round(t.loss, 6) AS train_loss, round(exp(t.loss), 6) AS train_perplexity, round(t.loss / ln(2), 6) AS train_bpc,
  round(t.top1_accuracy, 6) AS train_top1_accuracy,
  round(v.loss, 6) AS val_loss, round(exp(v.loss), 6) AS val_perplexity, round(v.loss / ln(2), 6) AS val_bpc,
  round(v.top1_accuracy, 6) AS val_top1_accuracy, TRUE AS timed
FROM report t JOIN report v ON t.seed = v.seed AND t.split = 'train' AND v.split = 'val'"""

_PROMPT_CTES = _PROMPTS[len(_STREAM):]

ORACLE["sample_text"] = _EVAL + _PROMPT_CTES + """,
t AS (
  SELECT p.ctx_id, p.token_id, CASE WHEN h.token_id IS NOT NULL THEN (p.logit / 0.8) / 1.3 ELSE p.logit / 0.8 END AS logit
  FROM pscores p LEFT JOIN hist h ON h.ctx_id = p.ctx_id AND h.token_id = p.token_id
),
k AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY ctx_id ORDER BY logit DESC) AS rk FROM t) WHERE rk <= 20),
pr AS (SELECT ctx_id, token_id, exp(logit - max(logit) OVER (PARTITION BY ctx_id)) AS e FROM k),
cu AS (
  SELECT ctx_id, token_id, sum(e / tot) OVER (PARTITION BY ctx_id ORDER BY token_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM (SELECT *, sum(e) OVER (PARTITION BY ctx_id) AS tot FROM pr)
),
drawn AS (
  SELECT r.seed, cu.ctx_id,
    coalesce(min(CASE WHEN cum > """ + sql_uniform_cols("r.seed", "cu.ctx_id") + """ THEN token_id END), max(token_id)) AS token_id
  FROM cu, runs r GROUP BY r.seed, cu.ctx_id
),
bp AS (SELECT item_id, text, row_number() OVER (ORDER BY item_id) - 1 AS p, count(*) OVER () AS n FROM benchmark),
picks AS (SELECT i.i, bp.item_id, bp.text FROM range(0, 3) i(i) JOIN bp ON bp.p = i.i % bp.n),
texts AS (
  SELECT d.seed, k.text AS prompt, k.text || v.token AS text
  FROM picks k JOIN drawn d ON d.ctx_id = k.item_id JOIN char_vocab v ON v.id = d.token_id
)
SELECT prompt, CAST(count(*) AS BIGINT) AS samples, CAST(count(DISTINCT text) AS BIGINT) AS distinct_texts
FROM texts GROUP BY prompt"""

ORACLE["story_files"] = "WITH " + STORIES + """
SELECT split, CAST(row_number() OVER (PARTITION BY split ORDER BY doc_id, pos) - 1 AS BIGINT) AS idx, story FROM stories"""

ORACLE["tokenizer_files"] = _BPE_ENC + """
SELECT s.doc_id, s.pos, s.story AS text FROM stories s JOIN story_ids i USING (doc_id, pos)
WHERE NOT list_contains(string_split(i.ids, ','), '1')"""

ORACLE["triplet_files"] = _SFT + """
SELECT conv_id, turn, split, array_to_string(tokens, ',') AS tokens, array_to_string(targets, ',') AS targets,
  array_to_string(mask, ',') AS mask
FROM trip"""

ORACLE["special_pair"] = _SFT + """,
prompt_ids AS (
  SELECT t.conv_id, t.turn, list(w.id ORDER BY t.tpos, w.si) AS a FROM sp_tok t JOIN word_ids2 w ON w.word = t.word GROUP BY t.conv_id, t.turn
)
SELECT conv_id, turn, array_to_string(list_concat(list_concat([2], a), list_concat([3], f[2:])), ',') AS ids
FROM prompt_ids JOIN full_ids USING (conv_id, turn)"""

_BPE_STREAM = _BPE_ENC + """,
last_one AS (SELECT split, max(doc_id * 1000000 + pos) AS place FROM stories GROUP BY split),
bpe_parts AS (
  SELECT t.split, t.doc_id, t.pos, t.tpos, w.si, w.id FROM tokens t JOIN word_ids2 w ON w.word = t.word
  UNION ALL SELECT s.split, s.doc_id, s.pos, 1000000000 + j.j, 0, (SELECT id FROM bpe_vocab WHERE token = '0A')
  FROM stories s JOIN last_one l USING (split), (VALUES (1), (2)) j(j) WHERE s.doc_id * 1000000 + s.pos < l.place
  UNION ALL SELECT split, -1, 0, 0, 0, 2 FROM last_one
  UNION ALL SELECT split, 9223372036854775807, 0, 0, 0, 3 FROM last_one
),
bpe_positions AS (
  SELECT split, CAST(row_number() OVER (PARTITION BY split ORDER BY doc_id, pos, tpos, si) - 1 AS BIGINT) AS gpos, id AS token FROM bpe_parts
)"""

ORACLE["pack_bpe_stream"] = _BPE_STREAM + """
SELECT split, gpos // 4096 AS block_id, CAST(count(*) AS BIGINT) AS n_tokens, string_agg(CAST(token AS VARCHAR), ',' ORDER BY gpos) AS ids
FROM bpe_positions GROUP BY ALL"""

ORACLE["bpe_stream_eval"] = _BPE_STREAM + """,
bp AS (SELECT * FROM (SELECT split, token, lead(token) OVER (PARTITION BY split ORDER BY gpos) AS nxt FROM bpe_positions) WHERE nxt IS NOT NULL),
bc AS (SELECT token, nxt, count(*) AS c FROM bp WHERE split = 'train' GROUP BY ALL),
bx AS (SELECT token, sum(c) AS tot, arg_min(nxt, (-c, nxt)) AS pred FROM bc GROUP BY token),
bs AS (
  SELECT split, -ln((coalesce(c, 0) + 1.0) / (coalesce(tot, 0) + (SELECT count(*) FROM bpe_vocab))) AS nll, CAST(coalesce(pred, 0) = bp.nxt AS INTEGER) AS hit
  FROM bp LEFT JOIN bc ON bc.token = bp.token AND bc.nxt = bp.nxt LEFT JOIN bx ON bx.token = bp.token
)
SELECT split, CAST(count(*) AS BIGINT) AS n_tokens, round(avg(nll), 6) AS loss, round(exp(avg(nll)), 6) AS perplexity,
  round(avg(nll) / ln(2), 6) AS bpc, round(avg(hit), 6) AS top1_accuracy
FROM bs GROUP BY split"""

ORACLE["eval_throughput"] = _EVAL + """
SELECT split, CAST(count(*) AS BIGINT) AS tokens, TRUE AS timed FROM win_pairs GROUP BY split"""

# ---------------------------------------------------------------- streaming forms
ORACLE["stream_best"] = _LOG + """
SELECT run, val_loss AS best_loss, step AS best_step FROM (
  SELECT run, step, val_loss, row_number() OVER (PARTITION BY run ORDER BY val_loss, step) AS rn FROM log)
WHERE rn = 1"""

ORACLE["stream_word_counts"] = _TOK + "\nSELECT word, CAST(count(*) AS BIGINT) AS freq FROM tokens GROUP BY word"

ORACLE["stream_records"] = _RECS + "\nSELECT prompt, response FROM assembled"

ORACLE["stream_progress"] = _RECS + """
SELECT CAST(count(*) AS BIGINT) AS processed, CAST(count(*) FILTER (length(prompt) > 0 AND length(response) > 0) AS BIGINT) AS written,
  CAST(count(*) FILTER (NOT (length(prompt) > 0 AND length(response) > 0)) AS BIGINT) AS skipped, CAST(count(*) AS BIGINT) AS stored
FROM assembled"""
