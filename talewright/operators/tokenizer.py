"""Tokenizers as DataFrame jobs (TOK1-TOK7, TOK9, TOK11).

Char level: vocabulary = distinct characters of the train text by code point.
Byte-level BPE: pre-tokenization with the GPT-2 pattern, word and pair counts,
special tokens; training and encoding are in :mod:`talewright.operators.bpe`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import chars_of  # noqa: F401  (re-exported)
from .lookup import by_id, char_id, char_pages

# The public GPT-2 byte-level pre-tokenization pattern, and the
# special tokens in id order 0..3.
# (?U): white space and letters are those of Unicode, as in the public library.
GPT2_PATTERN = r"""(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIALS = ["[PAD]", "[UNK]", "[BOS]", "[EOS]"]
PAD_ID, UNK_ID, BOS_ID, EOS_ID = 0, 1, 2, 3

REPLACEMENT = "\ufffd"      # what an unknown id decodes to


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- char level


def char_vocab(train: DataFrame, col: str = "story", separator: str = "\n\n") -> DataFrame:
    """TOK1: distinct characters of the train text (stories joined by
    ``separator``) sorted by code point -> dense ids from 0. Per-partition
    distinct first, so only the alphabet is shuffled."""
    # distinct per text first: the exploded rows are the alphabet of each text, not every character
    chars = train.select(F.explode(F.array_distinct(chars_of(col))).alias("token"))
    sep = train.sparkSession.createDataFrame([(c,) for c in sorted(set(separator))], "token string")
    alphabet = chars.unionByName(sep).distinct()
    # The alphabet is bounded by the number of code points: one small window.
    return alphabet.select(
        (F.row_number().over(Window.orderBy("token")) - 1).cast("int").alias("id"), "token"
    )


def char_encode(df: DataFrame, vocab: DataFrame, col: str = "story", out: str = "ids", on_oov: str = "error") -> DataFrame:
    """TOK2: characters -> ids, each by one read of a table of code points.
    ``on_oov``: ``error`` (the reference raises), ``unk`` (one id past the
    vocabulary), ``drop`` (skip unknown characters) or ``flag`` (skip them and
    count them in ``n_oov``)."""
    if on_oov not in ("error", "unk", "drop", "flag"):
        raise ValueError(on_oov)
    rows = vocab.select("token", "id").collect()      # bounded by the code points
    pages = char_pages(rows)
    if on_oov == "unk":
        return df.withColumn(out, F.transform(chars_of(col), lambda c: F.coalesce(char_id(pages, c), F.lit(len(rows)))))
    if on_oov == "error":
        unknown = F.raise_error(F.lit("character not in vocabulary")).cast("int")
        return df.withColumn(out, F.transform(chars_of(col), lambda c: F.coalesce(char_id(pages, c), unknown)))
    d = df.withColumn("_ids", F.transform(chars_of(col), lambda c: char_id(pages, c)))
    if on_oov == "flag":
        d = d.withColumn("n_oov", F.size(F.filter("_ids", lambda x: x.isNull())).cast("bigint"))
    return d.withColumn(out, F.filter("_ids", lambda x: x.isNotNull())).drop("_ids")


def char_decode(df: DataFrame, vocab: DataFrame, col: str = "ids", out: str = "text") -> DataFrame:
    """TOK3: ids -> text; an id outside the vocabulary becomes U+FFFD."""
    names = by_id(((r["id"], r["token"]) for r in vocab.select("id", "token").collect()), "string")
    return df.withColumn(out, F.array_join(F.transform(col, lambda i: F.coalesce(F.get(names, i), F.lit(REPLACEMENT))), ""))


# ---------------------------------------------------------------- byte-level BPE


def pretokenize(df: DataFrame, col: str = "story", out: str = "words") -> DataFrame:
    """TOK4: byte-level pre-tokenization, no added prefix space."""
    return df.withColumn(out, F.regexp_extract_all(_c(col), F.lit(GPT2_PATTERN), 0))


def word_counts(tokens: DataFrame, col: str = "words", extra: DataFrame | None = None) -> DataFrame:
    """TOK5: frequency of every pre-token (partial + final hash aggregate).
    ``extra`` (word, freq) rows are added, e.g. the separator pre-tokens of a
    joined corpus."""
    words = tokens.select(F.explode(col).alias("word"))
    if extra is None:
        return words.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    # one aggregation of both: the counted words are not shuffled again
    both = words.withColumn("freq", F.lit(1).cast("bigint")).unionByName(extra.select("word", F.col("freq").cast("bigint")))
    return both.groupBy("word").agg(F.sum("freq").alias("freq"))


def byte_symbols(col) -> Column:
    """TOK6: UTF-8 bytes as delimited hex symbols: ``He`` -> ``<48><65>``."""
    return F.regexp_replace(F.hex(F.encode(_c(col), "UTF-8")), "(..)", "<$1>")


def symbols_of(seg) -> Column:
    """``<48><65>`` -> ``["48", "65"]``."""
    s = _c(seg)
    return F.split(F.substring(s, 2, F.length(s) - 2), "><")


def pairs_of(seg) -> Column:
    """Adjacent symbol pairs of a segment (array of struct<left_tok,right_tok>)."""
    syms = symbols_of(seg)
    n = F.size(syms)
    return F.arrays_zip(F.slice(syms, 1, n - 1).alias("left_tok"), F.slice(syms, 2, n - 1).alias("right_tok"))


def pair_counts(words: DataFrame, seg: str = "seg", freq: str = "freq") -> DataFrame:
    """TOK7: weighted adjacent-pair frequency."""
    return (
        words.select(F.explode(pairs_of(seg)).alias("p"), freq)
        .groupBy(F.col("p.left_tok").alias("left_tok"), F.col("p.right_tok").alias("right_tok"))
        .agg(F.sum(freq).alias("count"))
    )


def add_specials(ids) -> Column:
    """TOK9: the single-sequence template ``[BOS] $A [EOS]``."""
    return F.concat(F.array(F.lit(BOS_ID)), _c(ids), F.array(F.lit(EOS_ID)))


def add_specials_pair(a, b) -> Column:
    """TOK9: the pair template ``[BOS] A [EOS] B [EOS]``."""
    return F.concat(F.array(F.lit(BOS_ID)), _c(a), F.array(F.lit(EOS_ID)), _c(b), F.array(F.lit(EOS_ID)))


def token_stats(encoded: DataFrame, tokenizer_col: str = "tokenizer", ids_col: str = "ids", n_col: str | None = None) -> DataFrame:
    """TOK11: texts and average tokens per text by tokenizer (``n_col``: the
    tokens of a text, already counted)."""
    n = F.col(n_col) if n_col else F.size(ids_col)
    return encoded.groupBy(tokenizer_col).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.sum(n).cast("bigint").alias("n_tokens"),
        F.avg(n).alias("avg_tokens"),
    )
