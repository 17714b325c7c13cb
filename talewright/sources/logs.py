"""Benchmark logs: read nested run logs, explode generated samples, write
a summary log (SRC9, SRC10, SNK5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS = "struct<loss:double,perplexity:double,bpc:double,top1_accuracy:double,tokens_per_sec:double>"
RUN = (
    "struct<checkpoint:string,seed:int,params:bigint,d_model:int,context_length:int,eval_iters:int,batch_size:int,"
    f"train:{METRICS},val:{METRICS},samples:array<struct<prompt:string,text:string>>>"
)
LOG_SCHEMA = (
    "timestamp string, tag string, checkpoint_name string, num_runs int, val_loss_mean double, val_loss_std double, "
    f"val_ppl_mean double, val_ppl_std double, runs array<{RUN}>"
)
METRIC_NAMES = ["loss", "perplexity", "bpc", "top1_accuracy", "tokens_per_sec"]


def read_benchmark_logs(spark: SparkSession, path: str) -> DataFrame:
    """SRC9: one row per run with flattened train / val metrics."""
    logs = spark.read.schema(LOG_SCHEMA).option("multiLine", True).json(path)
    runs = logs.select("tag", "timestamp", "checkpoint_name", F.posexplode("runs").alias("run_idx", "r"))
    flat = [F.col(f"r.{k}").alias(k) for k in ("checkpoint", "seed", "params", "d_model", "context_length", "eval_iters", "batch_size")]
    for split in ("train", "val"):
        flat += [F.col(f"r.{split}.{m}").alias(f"{split}_{m}") for m in METRIC_NAMES]
    return runs.select("tag", "timestamp", "checkpoint_name", "run_idx", *flat, F.col("r.samples").alias("samples"))


def explode_samples(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC10: (tag, seed, sample_idx, prompt, text) and the number of distinct
    texts per (tag, prompt) across seeds (exposes identical samples)."""
    s = runs.select("tag", "seed", F.posexplode("samples").alias("sample_idx", "s")).select(
        "tag", "seed", "sample_idx", F.col("s.prompt").alias("prompt"), F.col("s.text").alias("text"))
    distinct = s.groupBy("tag", "prompt").agg(
        F.count(F.lit(1)).alias("samples"), F.count_distinct("text").alias("distinct_texts"))
    return s, distinct


def summary_log(runs: DataFrame, tag: str, checkpoint_name: str) -> DataFrame:
    """Summary row over per-run rows (seed, params..., train_*, val_*):
    mean and population std of val loss and perplexity plus the nested runs.
    Runs are a sweep (parameter-sized), so one summary row holds them."""
    nest = lambda split: F.struct(*[F.col(f"{split}_{m}").alias(m) for m in METRIC_NAMES])
    run = F.struct(
        *[F.col(c) for c in ("checkpoint", "seed", "params", "d_model", "context_length", "eval_iters", "batch_size")
          if c in runs.columns],
        nest("train").alias("train"), nest("val").alias("val"),
        *([F.col("samples")] if "samples" in runs.columns else []),
    )
    return runs.agg(
        F.count(F.lit(1)).cast("int").alias("num_runs"),
        F.avg("val_loss").alias("val_loss_mean"), F.stddev_pop("val_loss").alias("val_loss_std"),
        F.avg("val_perplexity").alias("val_ppl_mean"), F.stddev_pop("val_perplexity").alias("val_ppl_std"),
        F.array_sort(F.collect_list(F.struct(F.col("seed").alias("_o"), run.alias("_r")))).alias("_runs"),
    ).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit(tag).alias("tag"), F.lit(checkpoint_name).alias("checkpoint_name"),
        "num_runs", "val_loss_mean", "val_loss_std", "val_ppl_mean", "val_ppl_std",
        F.transform("_runs", lambda x: x["_r"]).alias("runs"),
    )


def write_benchmark_log(summary: DataFrame, out_dir: str, tag: str, mode: str = "errorifexists") -> str:
    """SNK5: write the summary to ``out_dir/<yyyyMMdd_HHmmss>_<tag>`` (Spark
    writes a directory holding one JSON file). Returns the path."""
    stamp = summary.sparkSession.range(1).select(
        F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")).collect()[0][0]
    path = f"{out_dir.rstrip('/')}/{stamp}_{tag}"
    summary.coalesce(1).write.mode(mode).json(path)
    return path
