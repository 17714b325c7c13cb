"""Token streams and training samples (TOK12, SFT1-SFT6, SMP4).

A split's token stream is the concatenation of its texts in order with a
separator between them. It is stored as fixed-size blocks
``(split, block_id, ids)``: offsets come from the two-level prefix sum, each
text is cut into the pieces that fall into each block, and a block gathers
at most ``block_size`` tokens, so no group is unbounded. The texts of a bucket lie
together for their offsets, and so do their blocks: only the pieces of a block
that is no whole one there, at the ends of a bucket, travel again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from .ordering import running_sum
from .tokenizer import BOS_ID, EOS_ID, PAD_ID


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pack_stream(
    encoded: DataFrame,
    order_cols: Sequence[str],
    bucket,
    sep_ids: Sequence[int] | str,
    block_size: int = 4096,
    split_col: str = "split",
    ids_col: str = "ids",
    bos_eos: bool = False,
    ends: tuple[str, str] | None = None,
) -> DataFrame:
    """TOK12: blocks of the per-split token stream
    ``[BOS] t1 sep t2 sep ... tn [EOS]`` (BOS/EOS only with ``bos_eos``).

    Output: (split, block_id bigint, ids array<int>). A text column may stand for
    the ids if each character is a token: ``sep_ids`` is a string then, ``ends`` are
    the characters of [BOS] and [EOS] (``bos_eos`` needs them), and the blocks hold
    text, which is a quarter of its ids or less in the shuffle."""
    is_text = isinstance(sep_ids, str)
    if is_text and bos_eos and not ends:
        raise ValueError("a text stream has no [BOS] and [EOS] of its own")
    cut, size = (F.substring, F.length) if is_text else (F.slice, F.size)
    sep = F.lit(sep_ids) if is_text else F.array(*[F.lit(int(i)) for i in sep_ids]).cast("array<int>")
    nsep = len(sep_ids)
    lead = 1 if bos_eos else 0
    seq = F.concat(_c(ids_col), sep)
    d = encoded.select(split_col, *order_cols, seq.alias("_seq"))
    d = d.withColumn("_len", size("_seq").cast("bigint"))
    d = running_sum(d, "_len", order_cols, bucket, [split_col], out="_start", inclusive=False, total_col="_total", bucket_col="_bucket")
    # content ends before the trailing separator of the last text
    end = F.col("_total") - F.lit(nsep) + F.lit(lead)
    start = F.col("_start") + F.lit(lead)
    d = d.withColumn("_start", start).withColumn("_end", end)
    d = d.withColumn("_seq", cut("_seq", F.lit(1), F.greatest(F.least(F.col("_len"), F.col("_end") - F.col("_start")), F.lit(0)).cast("int")))
    d = d.withColumn("_len", size("_seq").cast("bigint")).filter(F.col("_len") > 0)
    k = F.lit(block_size)
    first_b = F.floor(F.col("_start") / k)
    last_b = F.floor((F.col("_start") + F.col("_len") - 1) / k)
    d = d.select(split_col, "_bucket", "_seq", "_start", "_len", "_end")
    parts = d.select("*", F.explode(F.sequence(first_b, last_b)).alias("block_id"))
    lo = F.greatest(F.col("block_id") * k, F.col("_start"))
    hi = F.least((F.col("block_id") + 1) * k, F.col("_start") + F.col("_len"))
    pieces = parts.select(
        split_col, "_bucket", F.col("block_id").cast("bigint").alias("block_id"), lo.alias("off"),
        cut("_seq", (lo - F.col("_start") + 1).cast("int"), (hi - lo).cast("int")).alias("piece"),
    )

    def gathered(pieces: DataFrame, *keys: str) -> DataFrame:
        found = pieces.groupBy(split_col, *keys).agg(F.array_sort(F.collect_list(F.struct("off", "piece"))).alias("_p"))
        part = F.transform("_p", lambda p: p["piece"])
        return found.select(split_col, "block_id", F.col("_p")[0]["off"].alias("off"),
                            (F.array_join(part, "") if is_text else F.flatten(part)).alias("piece"))

    blocks = gathered(pieces, "_bucket", "block_id")
    whole = size("piece") == k
    edges = blocks.filter(~whole)
    if bos_eos:
        bos, eos = map(F.lit, ends) if is_text else (F.array(F.lit(i)) for i in (BOS_ID, EOS_ID))
        last = d.groupBy(split_col).agg(F.max("_end").alias("_end"))
        edges = edges.unionByName(last.select(split_col, F.lit(0).cast("bigint").alias("block_id"), F.lit(0).cast("bigint").alias("off"),
                                              bos.alias("piece")))
        edges = edges.unionByName(last.select(split_col, F.floor(F.col("_end") / k).cast("bigint").alias("block_id"),
                                              F.col("_end").cast("bigint").alias("off"), eos.alias("piece")))
    out = blocks.filter(whole).unionByName(gathered(edges, "block_id"))
    return out.select(split_col, "block_id", F.col("piece").alias(ids_col))


def stream_positions(blocks: DataFrame, block_size: int, split_col: str = "split", ids_col: str = "ids") -> DataFrame:
    """Explode blocks to (split, gpos, token)."""
    d = blocks.select(split_col, "block_id", F.posexplode(ids_col).alias("i", "token"))
    return d.select(split_col, (F.col("block_id") * F.lit(block_size) + F.col("i")).alias("gpos"), "token")


def next_token_pairs(blocks: DataFrame, split_col: str = "split", ids_col: str = "ids", block_size: int = 4096) -> DataFrame:
    """SFT6: (token, next token) at every position of each stream. Inside a
    block by array zip, where the block is read; across a block edge by joining
    its last token with the first one of the next block (one row per block, the
    blocks themselves are not shuffled)."""
    n = F.size(ids_col)
    z = F.arrays_zip(F.slice(ids_col, 1, F.greatest(n - 1, F.lit(0))).alias("token"), F.slice(ids_col, 2, n).alias("next_token"))
    gpos = lambda i: (F.col("block_id") * F.lit(block_size) + i).alias("gpos")
    inside = blocks.select(split_col, "block_id", F.posexplode(z).alias("i", "p")).select(
        split_col, gpos(F.col("i")), F.col("p.token").alias("token"), F.col("p.next_token").alias("next_token"))
    lasts = blocks.select(split_col, "block_id", gpos(n - 1), F.element_at(ids_col, -1).alias("token"))
    heads = blocks.select(split_col, (F.col("block_id") - 1).alias("block_id"), F.element_at(ids_col, 1).alias("next_token"))
    edges = lasts.join(heads, [split_col, "block_id"]).select(split_col, "gpos", "token", "next_token")
    return inside.unionByName(edges).filter(F.col("next_token").isNotNull())


def window_batch(
    blocks: DataFrame, draws: DataFrame, split_sizes: DataFrame, block_size: int,
    split_col: str = "split", ids_col: str = "ids",
) -> DataFrame:
    """SMP4: windows drawn with replacement.

    ``draws``: one row per window with ``split``, ``draw``, ``seed`` and
    ``context_length`` (T) plus any run keys; ``split_sizes``: (split,
    n_tokens). Start is uniform in ``[0, n_tokens - T)`` from
    ``md5(seed:draw)``; ``x = ids[s:s+T]``, ``y = ids[s+1:s+T+1]``; windows
    cross text boundaries. Each draw touches at most ``ceil((T+1)/block)+1``
    blocks and is joined to exactly those blocks; the draw table is sized by
    parameters (runs x batches x batch size), never by the data."""
    keys = [c for c in draws.columns if c not in (split_col,)]
    d = draws.join(F.broadcast(split_sizes), split_col)
    span = F.col("n_tokens") - F.col("context_length")
    d = d.filter(span > 0).withColumn(
        "start", F.floor(uniform(F.col("seed"), "draw") * span).cast("bigint"))
    k = F.lit(block_size)
    d = d.withColumn("block_id", F.explode(F.sequence(
        F.floor(F.col("start") / k), F.floor((F.col("start") + F.col("context_length")) / k))))
    # ``d`` is sized by the run parameters: a bounded broadcast.
    j = F.broadcast(d).join(blocks, on=[split_col, "block_id"])
    # only the window's part of a block is shuffled
    lo = F.greatest(F.col("start") - F.col("block_id") * k, F.lit(0))
    hi = F.col("start") + F.col("context_length") - F.col("block_id") * k
    piece = F.slice(ids_col, (lo + 1).cast("int"), (hi - lo + 1).cast("int")).alias("piece")
    g = j.groupBy(split_col, *keys, "start").agg(F.array_sort(F.collect_list(F.struct("block_id", piece))).alias("_p"))
    T = F.col("context_length").cast("int")
    g = g.withColumn("_w", F.flatten(F.transform("_p", lambda p: p["piece"])))
    return g.select(split_col, *keys, "start", F.slice("_w", 1, T).alias("x"), F.slice("_w", 2, T).alias("y"))


def draw_table(spark: SparkSession, runs: DataFrame, splits, batch_col: str = "batch_size", iters_col: str = "eval_iters") -> DataFrame:
    """Draw rows for every run and split: ``draw`` in [0, iters x batch),
    ``batch = draw / batch_size``."""
    sp = F.array(*[F.lit(s) for s in splits])
    d = runs.select("*", F.explode(sp).alias("split"))
    d = d.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col(iters_col) * F.col(batch_col) - 1).cast("bigint"))).alias("draw"))
    return d.withColumn("batch", F.floor(F.col("draw") / F.col(batch_col)).cast("bigint"))


# ---------------------------------------------------------------- SFT samples


def truncate_pad(ids, context: int, pad: int = PAD_ID) -> Column:
    """SFT1: cut to ``context`` tokens, right-pad with ``pad`` to exactly ``context``."""
    return F.slice(F.concat(_c(ids), F.array_repeat(F.lit(pad), context)), 1, context)


def shift_targets(ids, context: int, pad: int = PAD_ID) -> Column:
    """SFT2: ``tokens[1:] + [pad]`` after truncation, then padded."""
    t = F.slice(_c(ids), 1, context)
    shifted = F.concat(F.slice(t, 2, context), F.array(F.lit(pad)))
    return truncate_pad(shifted, context, pad)


def loss_mask(full_len, prompt_len, context: int, compat: bool = True) -> Column:
    """SFT3: 1 for ``i`` in ``[max(0, P-1), L-1)``, else 0, with
    ``L = min(full_len, C)``. ``compat`` keeps the reference's P (the prompt
    encoded alone, with its EOS); ``compat=False`` uses ``P-1``."""
    L = F.least(_c(full_len), F.lit(context))
    P = _c(prompt_len) if compat else _c(prompt_len) - 1
    lo = F.greatest(F.lit(0), P - 1)
    return F.transform(
        F.sequence(F.lit(0), F.lit(context - 1)),
        lambda i: F.when((i >= lo) & (i < L - 1), F.lit(1.0)).otherwise(F.lit(0.0)).cast("float"),
    )


def sft_triplets(encoded: DataFrame, context: int, full_col: str = "full_ids", prompt_col: str = "prompt_ids", compat: bool = True) -> DataFrame:
    """SFT4: encoded record -> (tokens, targets, mask), each of length ``context``."""
    return encoded.select(
        "*",
        truncate_pad(full_col, context).alias("tokens"),
        shift_targets(full_col, context).alias("targets"),
        loss_mask(F.size(full_col), F.size(prompt_col), context, compat).alias("mask"),
    )


def mask_coverage(triplets: DataFrame, context: int, full_col: str = "full_ids") -> DataFrame:
    """SFT5: rows, rows truncated, rows whose mask is all zero, response
    tokens kept (sum of the mask)."""
    msum = F.aggregate("mask", F.lit(0.0).cast("double"), lambda a, x: a + x)
    return triplets.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size(full_col) > F.lit(context)).alias("truncated"),
        F.count_if(msum == 0).alias("all_zero_mask"),
        F.sum(msum).cast("bigint").alias("response_tokens"),
    )
