"""Incremental data jobs on Structured Streaming (STR1-STR4).

All sinks keep their progress in a checkpoint location inside the cluster's
shared checkpoint folder (``spark.checkpoint.dir``), so a restarted or
re-run query resumes without repeating work and survives executor loss.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import END_OF_TEXT, block_records
from ..operators.tokenizer import pretokenize
from ..session import ensure_checkpoint_dir


COUNTERS = ["processed", "written", "skipped"]


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A named checkpoint folder under the shared checkpoint directory."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", name)


def record_stream(spark: SparkSession, in_dir: str, max_files: int | None = None) -> DataFrame:
    """STR1 source side: new files of instruction lines, one block per row (the
    delimiter is the record separator), stateless: a file of any size is read
    split by split. The delimiter must not stand inside a line of text."""
    reader = spark.readStream.format("text").option("lineSep", END_OF_TEXT)
    raw = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(in_dir)
    d = raw.select(F.col("_metadata.file_path").alias("file"), "value")
    return block_records(d).select("file", "prompt", "response")


def _observed(batch: DataFrame) -> tuple[DataFrame, Observation]:
    """STR2: processed / written / skipped, counted by the job that writes the batch."""
    seen = Observation()
    ok = (F.length("prompt") > 0) & (F.length("response") > 0)
    return batch.observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if(ok).alias("written"),
                         F.count_if(~ok).alias("skipped")), seen


def progress_dir(out_dir: str) -> str:
    """Where the counters of a record build stand: beside its records."""
    return out_dir.rstrip("/") + "-progress"


def build_records_incrementally(spark: SparkSession, in_dir: str, out_dir: str, name: str = "sft_records",
                                checkpoint: str | None = None, max_files: int | None = None):
    """STR1: append the records of new files to Parquet (``max_files`` per
    micro-batch); ``availableNow`` processes what is there and stops; a second
    run adds nothing.

    STR2: each micro-batch writes its records and then one row of counters, both
    under its number, so a batch that is tried again replaces its own part, and
    the totals are exact however many batches there were."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows, seen = _observed(batch)
        rows.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")
        counts = [seen.get[k] for k in COUNTERS]
        (spark.createDataFrame([counts], ", ".join(f"{k} bigint" for k in COUNTERS)).coalesce(1)
         .write.mode("overwrite").parquet(f"{progress_dir(out_dir)}/batch={batch_id}"))

    q = (record_stream(spark, in_dir, max_files).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint or checkpoint_location(spark, name))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def progress_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    """STR2: one row, the counters of all micro-batches so far."""
    rows = spark.read.parquet(progress_dir(out_dir))
    return rows.agg(*[F.sum(k).alias(k) for k in COUNTERS])


def live_best(log_stream: DataFrame, run: str = "run", step: str = "step", loss: str = "val_loss") -> DataFrame:
    """STR3: best validation loss so far per run, and the step it came from
    (ties -> first step). Streaming aggregate: state is one row per run."""
    best = F.min(F.struct(F.col(loss), F.col(step)))
    return log_stream.groupBy(run).agg(best.alias("_b")).select(
        run, F.col("_b")[loss].alias("best_loss"), F.col("_b")[step].alias("best_step"))


def append_word_counts(story_stream: DataFrame, path: str, checkpoint: str, col: str = "story") -> None:
    """STR4, incremental: each micro-batch adds its own counts as one part of
    the table (written again under the same number if the batch is retried),
    so a batch costs its own words and not the whole vocabulary."""
    words = pretokenize(story_stream, col).select(F.explode("words").alias("word"))

    def add(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("word").agg(F.count(F.lit(1)).alias("freq")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    words.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def summed_word_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all micro-batches so far."""
    return spark.read.parquet(path).groupBy("word").agg(F.sum("freq").alias("freq"))


def word_count_stream(story_stream: DataFrame, col: str = "story") -> DataFrame:
    """STR4: running pre-token counts of a growing corpus."""
    return pretokenize(story_stream, col).select(F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("freq"))
