"""Count-based next-token model (NGM1-NGM3): the re-aimed form of model
fitting. Context = previous token; add-alpha smoothing over the vocabulary.

Every step pre-aggregates before it shuffles: pairs become
(context, next, multiplicity) first, so a hot pair costs one row."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LN2 = math.log(2.0)


def pair_multiplicity(pairs: DataFrame, ctx: str = "token", nxt: str = "next_token", by: list[str] | None = None) -> DataFrame:
    keys = [*(by or []), ctx, nxt]
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def ngram_fit(pairs: DataFrame, vocab_size: int, alpha: float = 1.0, ctx: str = "token", nxt: str = "next_token") -> DataFrame:
    """NGM1: (ctx, next, count, ctx_total, logprob, pred) with
    ``logprob = ln((count + a) / (ctx_total + a * V))`` and ``pred`` the
    context's most frequent next token (ties -> lowest id)."""
    counts = pair_multiplicity(pairs, ctx, nxt).withColumnRenamed("n", "count")
    per_ctx = counts.groupBy(ctx).agg(
        F.sum("count").alias("ctx_total"),
        F.max_by(nxt, F.struct(F.col("count"), -F.col(nxt))).alias("pred"),
    )
    m = counts.join(per_ctx, on=ctx)
    lp = F.log((F.col("count") + F.lit(alpha)) / (F.col("ctx_total") + F.lit(alpha * vocab_size)))
    return m.withColumn("logprob", lp)


def context_table(model: DataFrame, ctx: str = "token") -> DataFrame:
    """One row per context: total and prediction."""
    return model.select(ctx, "ctx_total", "pred").dropDuplicates([ctx])


def ngram_score(
    pairs: DataFrame, model: DataFrame, vocab_size: int, alpha: float = 1.0,
    ctx: str = "token", nxt: str = "next_token", by: list[str] | None = None,
) -> DataFrame:
    """NGM2: NLL and top-1 hit for every (ctx, next) occurrence, returned
    pre-aggregated as (by..., ctx, next, n, nll, correct). An unseen pair gets
    the smoothed floor ``a / (ctx_total + aV)``; an unseen context the
    uniform ``1/V`` and prediction 0 (argmax of a uniform row)."""
    if alpha <= 0:
        raise ValueError("alpha must be > 0 to score unseen pairs")
    mult = pair_multiplicity(pairs, ctx, nxt, by)
    pair_counts = model.select(ctx, nxt, "count")
    d = mult.join(pair_counts, on=[ctx, nxt], how="left").join(context_table(model, ctx), on=ctx, how="left")
    c = F.coalesce(F.col("count"), F.lit(0))
    tot = F.coalesce(F.col("ctx_total"), F.lit(0))
    nll = -F.log((c + F.lit(alpha)) / (tot + F.lit(alpha * vocab_size)))
    correct = (F.coalesce(F.col("pred"), F.lit(0)) == F.col(nxt)).cast("int")
    return d.select(*(by or []), ctx, nxt, "n", nll.alias("nll"), correct.alias("correct"))


def score_report(scored: DataFrame, by: list[str]) -> DataFrame:
    """Token-weighted loss, perplexity, bits per token, top-1 accuracy."""
    n = F.sum("n")
    loss = F.sum(F.col("n") * F.col("nll")) / n
    return scored.groupBy(*by).agg(
        n.cast("bigint").alias("n_tokens"),
        loss.alias("loss"),
        (F.sum(F.col("n") * F.col("correct")) / n).alias("top1_accuracy"),
    ).withColumn("perplexity", F.exp("loss")).withColumn("bpc", F.col("loss") / F.lit(LN2))


def ngram_eval(train_pairs: DataFrame, all_pairs: DataFrame, vocab_size: int, alpha: float = 1.0, split_col: str = "split") -> DataFrame:
    """NGM3: fit on the train stream, score every position of every split,
    report per split."""
    model = ngram_fit(train_pairs, vocab_size, alpha)
    return score_report(ngram_score(all_pairs, model, vocab_size, alpha, by=[split_col]), [split_col])
