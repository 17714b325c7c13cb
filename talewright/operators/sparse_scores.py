"""Sparse score tables: what a context has seen, and one floor for the rest
(AGG3, AGG8, TOP1).

A smoothed count model gives every token a score after every context, but all
tokens that never followed a context share one. So a table is kept as

* ``seen``   (ctx_id, token_id, logit): one row per observed pair, and
* ``floors`` (ctx_id, floor, rest): one row per context, ``rest`` tokens of
  score ``floor``; contexts never seen have ``rest`` = the vocabulary size.

Loss, arg max and top-k are exact on it; the full vocabulary x vocabulary table
is never made.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ngram import context_table


@dataclass
class SparseScores:
    seen: DataFrame
    floors: DataFrame
    vocab_size: int

    @classmethod
    def of_counts(cls, model: DataFrame, vocab_size: int, alpha: float = 1.0, ctx: str = "token",
                  nxt: str = "next_token") -> SparseScores:
        """Log-probabilities of an add-alpha count model (:func:`ngram.ngram_fit`)."""
        log_share = lambda count, total: F.log((count + F.lit(alpha)) / (total + F.lit(alpha * vocab_size)))
        seen = model.select(F.col(ctx).alias("ctx_id"), F.col(nxt).alias("token_id"),
                            log_share(F.col("count"), F.col("ctx_total")).alias("logit"))
        known = context_table(model, ctx).select(F.col(ctx).alias("ctx_id"), "ctx_total")
        known = known.join(seen.groupBy("ctx_id").agg(F.count("*").alias("n")), "ctx_id")
        every = model.sparkSession.range(vocab_size).select(F.col("id").cast("int").alias("ctx_id")).join(known, "ctx_id", "left")
        floors = every.select("ctx_id", log_share(F.lit(0), F.coalesce("ctx_total", F.lit(0))).alias("floor"),
                              (F.lit(vocab_size) - F.coalesce("n", F.lit(0))).alias("rest"))
        return cls(seen, floors, vocab_size)

    def log_sums(self) -> DataFrame:
        """(ctx_id, floor, lse): logsumexp over all tokens of a context, about
        the largest of its scores."""
        top = self.seen.groupBy("ctx_id").agg(F.max("logit").alias("top"))
        d = self.floors.join(top, "ctx_id", "left")
        d = d.withColumn("top", F.greatest("top", F.when(F.col("rest") > 0, F.col("floor"))))
        part = self.seen.join(d.select("ctx_id", "top"), "ctx_id").groupBy("ctx_id").agg(
            F.sum(F.exp(F.col("logit") - F.col("top"))).alias("part"))
        total = F.coalesce("part", F.lit(0.0)) + F.when(F.col("rest") > 0, F.col("rest") * F.exp(F.col("floor") - F.col("top"))).otherwise(0.0)
        return d.join(part, "ctx_id", "left").select("ctx_id", "floor", (F.col("top") + F.log(total)).alias("lse"))

    def token_nll(self, targets: DataFrame, ctx: str = "ctx_id", target: str = "target") -> DataFrame:
        """AGG3: cross entropy of every target row, no reduction; NULL for a
        context outside the vocabulary."""
        hit = self.seen.select(F.col("ctx_id").alias(ctx), F.col("token_id").alias(target), F.col("logit").alias("_logit"))
        sums = self.log_sums().withColumnRenamed("ctx_id", ctx)
        d = targets.join(sums, ctx, "left").join(hit, [ctx, target], "left")
        inside = F.col(target).between(0, self.vocab_size - 1)
        nll = F.col("lse") - F.coalesce("_logit", F.when(inside, F.col("floor")))
        return d.withColumn("nll", nll).drop("floor", "lse", "_logit")

    def argmax(self) -> DataFrame:
        """(ctx_id, pred): the token of the highest score; ties go to the lowest
        id, unseen tokens included."""
        best = self.seen.groupBy("ctx_id").agg(
            F.max_by("token_id", F.struct(F.col("logit"), -F.col("token_id"))).alias("token_id"), F.max("logit").alias("logit"),
            F.array_sort(F.collect_set("token_id")).alias("ids"))
        # the lowest unseen id: the first place at which the sorted ids run ahead
        gap = F.array_position(F.zip_with("ids", F.sequence(F.lit(0), F.size("ids") - 1), lambda x, i: x == i), F.lit(False))
        gap = F.when(gap > 0, gap - 1).otherwise(F.size("ids"))
        d = self.floors.join(best.select("ctx_id", "token_id", "logit", gap.alias("gap")), "ctx_id", "left")
        free = F.col("rest") > 0
        unseen = F.coalesce("gap", F.lit(0)).cast("int")
        pred = (F.when(F.col("token_id").isNull() | (free & (F.col("floor") > F.col("logit"))), unseen)
                .when(free & (F.col("floor") == F.col("logit")), F.least(unseen, "token_id")).otherwise(F.col("token_id")))
        return d.select("ctx_id", pred.cast("int").alias("pred"))

    def cuts(self, k: int) -> DataFrame:
        """(ctx_id, cut): the k-th largest score of every context (the smallest
        one if ``k`` is larger than the vocabulary)."""
        rank = F.row_number().over(Window.partitionBy("ctx_id").orderBy(F.desc("logit")))
        first = self.seen.withColumn("ahead", rank - 1).where(F.col("ahead") < k).join(self.floors, "ctx_id")
        ahead = F.col("ahead") + F.when(F.col("floor") > F.col("logit"), F.col("rest")).otherwise(F.lit(0))
        above = first.where(ahead < k).groupBy("ctx_id").agg(
            F.min("logit").alias("low"), F.count_if(F.col("logit") >= F.col("floor")).alias("n"))
        d = self.floors.join(above, "ctx_id", "left")
        fits = (F.col("rest") > 0) & (F.coalesce("n", F.lit(0)) < k)
        return d.select("ctx_id", F.least("low", F.when(fits, F.col("floor"))).alias("cut"))

    def of_contexts(self, contexts: DataFrame, key: str, ctx: str) -> DataFrame:
        """(key, token_id, logit): all scores of a list of contexts (prompts),
        each a row of its own."""
        wide = contexts.select(key, F.col(ctx).alias("ctx_id")).join(self.floors, "ctx_id")
        wide = wide.select(key, "ctx_id", "floor", F.explode(F.sequence(F.lit(0), F.lit(self.vocab_size - 1))).alias("token_id"))
        return wide.join(self.seen, ["ctx_id", "token_id"], "left").select(key, "token_id", F.coalesce("logit", "floor").alias("logit"))
