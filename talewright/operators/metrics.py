"""Evaluation metrics and training-log windows (AGG1-AGG11, WIN1-WIN4)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import running_agg

LN2 = math.log(2.0)


def corpus_profile(raw: DataFrame, records: DataFrame) -> DataFrame:
    """AGG1: raw rows, extracted records, record columns, in one aggregate
    over the union of both inputs (no join)."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    u = raw.select(one.alias("_r"), zero.alias("_c")).unionByName(records.select(zero.alias("_r"), one.alias("_c")))
    return u.agg(
        F.coalesce(F.sum("_r"), zero).alias("raw_rows"),
        F.coalesce(F.sum("_c"), zero).alias("records"),
    ).withColumn("n_columns", F.lit(len(records.columns)).cast("bigint"))


def prompt_diversity(df: DataFrame, col: str = "prompt", approx: bool = False) -> DataFrame:
    """AGG2: number of unique prompts (exact, or HyperLogLog++ with ``approx``)."""
    f = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(f.cast("bigint").alias("unique_prompts"))


def masked_mean(loss, mask) -> F.Column:
    """AGG4: ``sum(loss * mask) / max(sum(mask), 1)`` (an aggregate)."""
    return F.sum(F.col(loss) * F.col(mask)) / F.greatest(F.sum(F.col(mask)), F.lit(1.0))


def mean_of_batches(df: DataFrame, by: Sequence[str], batch_col: str = "batch", loss_col: str = "nll") -> DataFrame:
    """AGG5: mean of per-batch means (every batch weighs the same)."""
    per_batch = df.groupBy(*by, batch_col).agg(F.avg(loss_col).alias("_bl"))
    return per_batch.groupBy(*by).agg(F.count(F.lit(1)).alias("n_batches"), F.avg("_bl").alias("loss"))


def loss_metrics(df: DataFrame, loss_col: str = "loss") -> DataFrame:
    """AGG6: ``perplexity = exp(loss)``, ``bpc = loss / ln 2``."""
    return df.withColumn("perplexity", F.exp(loss_col)).withColumn("bpc", F.col(loss_col) / F.lit(LN2))


def bits_per_char(df: DataFrame, by: Sequence[str], nats_col: str = "nll", chars_col: str = "chars") -> DataFrame:
    """AGG7: total nats / (ln 2 x characters): comparable across tokenizers."""
    return df.groupBy(*by).agg(
        (F.sum(nats_col) / (F.lit(LN2) * F.sum(chars_col))).alias("bits_per_char"),
        F.sum(chars_col).cast("bigint").alias("chars"),
    )


def top1_accuracy(preds: DataFrame, targets: DataFrame, by: Sequence[str], ctx: str = "ctx_id", target: str = "target") -> DataFrame:
    """AGG8: share of targets equal to the arg max (``pred``) of their context;
    0 when there are no targets."""
    d = targets.join(preds, ctx, "left")
    hit = F.coalesce((F.col("pred") == F.col(target)).cast("int"), F.lit(0))
    return d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(hit) / F.count(F.lit(1)), F.lit(0.0)).alias("top1_accuracy"),
    )


def throughput(df: DataFrame, by: Sequence[str], tokens_col: str = "tokens", seconds_col: str = "seconds") -> DataFrame:
    """AGG9: total tokens / total seconds, 0 when no time was spent."""
    t = F.sum(tokens_col)
    s = F.sum(seconds_col)
    return df.groupBy(*by).agg(
        t.cast("bigint").alias("tokens"), s.alias("seconds"),
        F.when(s > 0, t / s).otherwise(F.lit(0.0)).alias("tokens_per_sec"),
    )


def seed_stability(runs: DataFrame, by: Sequence[str] = (), loss_col: str = "val_loss", ppl_col: str = "val_perplexity") -> DataFrame:
    """AGG10: mean and population standard deviation across runs."""
    return runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_runs"),
        F.avg(loss_col).alias("val_loss_mean"), F.stddev_pop(loss_col).alias("val_loss_std"),
        F.avg(ppl_col).alias("val_ppl_mean"), F.stddev_pop(ppl_col).alias("val_ppl_std"),
    )


# ---------------------------------------------------------------- log windows


def best_so_far(log: DataFrame, run: str, step: str, loss: str, bucket) -> DataFrame:
    """WIN1: running best loss; ``is_best`` iff strictly below every earlier
    loss of the run (the first is best). Two-level running minimum: a run
    with most of the log is cut into buckets."""
    d = running_agg(log, loss, [step], bucket, [run], out="best_before", inclusive=False, agg="min")
    return d.withColumn("is_best", F.col("best_before").isNull() | (F.col(loss) < F.col("best_before")))


def eval_points(log: DataFrame, run: str, step: str, interval: int) -> DataFrame:
    """WIN2: steps evaluated: ``step % interval == 0`` or the run's last step.
    The last step is a partial aggregate joined back (no window per run)."""
    last = log.groupBy(run).agg(F.max(step).alias("_last"))
    d = log.join(last, run)
    return d.filter((F.pmod(F.col(step), F.lit(interval)) == 0) | (F.col(step) == F.col("_last"))).drop("_last")


def run_delta(runs: DataFrame, model: str, order: str, metrics: Sequence[str]) -> DataFrame:
    """WIN3: change of each metric from the previous run of the same model.
    ``runs`` is a small per-run table (one row per run)."""
    w = Window.partitionBy(model).orderBy(order)
    d = runs
    for m in metrics:
        d = d.withColumn(f"{m}_delta", F.col(m) - F.lag(m).over(w))
    return d


def compare_runs(runs: DataFrame, group: str, family: str, metric: str) -> DataFrame:
    """WIN4: all families of each group side by side, best first (lowest
    metric, ties -> name): the rank of each and the group's ``winner``."""
    w = Window.partitionBy(group).orderBy(F.col(metric), F.col(family))
    ranked = runs.select(group, family, metric, F.row_number().over(w).alias("rank"))
    winner = ranked.filter(F.col("rank") == 1).select(group, F.col(family).alias("winner"))
    return ranked.join(winner, group)


def pick_best(log: DataFrame, run: str, step: str, loss: str) -> DataFrame:
    """TOP3 (metric tables): row of minimal loss per run (ties -> first step)."""
    best = F.min(F.struct(F.col(loss), F.col(step)))
    return log.groupBy(run).agg(best.alias("_b")).select(
        run, F.col("_b")[step].alias("best_step"), F.col("_b")[loss].alias("best_loss"))


def pick_checkpoint(available) -> str | None:
    """TOP3 (files): prefer ``best``, else ``latest``, else none."""
    names = set(available)
    for name in ("best", "latest"):
        if name in names:
            return name
    return None
