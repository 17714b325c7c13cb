"""Operators on score tables ``(ctx_id, token_id, logit)``: repetition
penalty, top-k filter and one seeded categorical draw per context
(JON3, TOP1, TOP2). A context holds at most one row per vocabulary entry,
so every window here is bounded by the vocabulary size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import uniform


def repetition_penalty(
    scores: DataFrame, history: DataFrame, penalty: float, signed: bool = False,
    ctx: str = "ctx_id", token: str = "token_id",
) -> DataFrame:
    """JON3: logits of tokens already seen in the context are divided by
    ``penalty``. Like the reference, negative logits are divided too (which
    raises them); ``signed=True`` multiplies negative ones instead."""
    seen = history.select(ctx, token).distinct().withColumn("_seen", F.lit(True))
    d = scores.join(seen, [ctx, token], "left")
    l = F.col("logit")
    pen = F.when((l < 0) & F.lit(signed), l * F.lit(penalty)).otherwise(l / F.lit(penalty))
    return d.withColumn("logit", F.when(F.col("_seen"), pen).otherwise(l)).drop("_seen")


def top_k_filter(scores: DataFrame, k: int, ctx: str = "ctx_id", out: str = "kept") -> DataFrame:
    """TOP1: keep tokens whose logit is >= the k-th largest of the context
    (ties kept; ``k`` larger than the row keeps everything)."""
    w = Window.partitionBy(ctx).orderBy(F.col("logit").desc())
    return scores.withColumn(out, F.rank().over(w) <= F.lit(k))


def sample_next(
    scores: DataFrame, history: DataFrame | None, temperature: float, k: int | None, penalty: float, seed: int,
    ctx: str = "ctx_id", token: str = "token_id",
) -> DataFrame:
    """TOP2: temperature -> repetition penalty -> top-k -> one categorical
    draw from the logits per context. The draw is ``uniform(seed, ctx)``
    against the cumulative softmax in token order: reproducible anywhere."""
    d = scores.withColumn("logit", F.col("logit") / F.lit(temperature))
    if history is not None and penalty != 1.0:
        d = repetition_penalty(d, history, penalty, ctx=ctx, token=token)
    if k is not None:
        d = top_k_filter(d, k, ctx).filter("kept").drop("kept")
    wc = Window.partitionBy(ctx)
    d = d.withColumn("_p", F.exp(F.col("logit") - F.max("logit").over(wc)))
    d = d.withColumn("_p", F.col("_p") / F.sum("_p").over(wc))
    wo = wc.orderBy(token).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_cum", F.sum("_p").over(wo)).withColumn("_u", uniform(seed, ctx))
    picked = d.groupBy(ctx).agg(
        F.min(F.when(F.col("_cum") > F.col("_u"), F.col(token))).alias("_hit"),
        F.max(token).alias("_last"),
    )
    return picked.select(ctx, F.coalesce("_hit", "_last").alias(token))
