"""Structured Streaming forms: stream result = batch result, restart adds
nothing, counters, live best = batch best, incremental word counts."""

import os
import shutil

from pyspark.sql import functions as F

from talewright.operators import blocks, metrics, ordering
from talewright.operators import tokenizer as tok
from talewright.plans import catalog
from talewright.streaming import incremental as inc

LONG = "Once upon a time there was a girl named Lily."


def _write_files(d, n_files=3):
    os.makedirs(d, exist_ok=True)
    all_lines = []
    for f in range(n_files):
        lines = [f"Features: F{f}", "Words: a, b", f"Summary: S{f}", "Story:", "", LONG, f"She was {f}.", "<|endoftext|>",
                 "Words: only", "<|endoftext|>", "Story:", "short", "<|endoftext|>", "stray", f"Story: {LONG} {f}"]
        with open(os.path.join(d, f"part-{f}.txt"), "w") as fh:
            fh.write("\n".join(lines))
        all_lines.append(lines)
    return all_lines


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    files = _write_files(src)
    inc.build_records_incrementally(spark, src, out, checkpoint=ck)
    got = sorted((r.prompt, r.response) for r in spark.read.parquet(out).collect())
    rows = [(f"f{i}", j, t) for i, lines in enumerate(files) for j, t in enumerate(lines)]
    lines_df = spark.createDataFrame(rows, "src string, line_no long, text string")
    b = blocks.assign_blocks(lines_df, "src", ["line_no"], ordering.bucket_of("line_no", 4))
    want = sorted((r.prompt, r.response) for r in blocks.assemble_records(b, ["src", "block"], "line_no").collect())
    assert got == want and len(got) == 6
    assert tuple(inc.progress_totals(spark, out).first()) == (6, 6, 0)
    # a second run over the same files adds nothing
    inc.build_records_incrementally(spark, src, out, checkpoint=ck)
    assert spark.read.parquet(out).count() == 6
    # a new file is picked up incrementally
    shutil.copy(os.path.join(src, "part-0.txt"), os.path.join(src, "part-9.txt"))
    inc.build_records_incrementally(spark, src, out, checkpoint=ck)
    assert spark.read.parquet(out).count() == 8
    assert tuple(inc.progress_totals(spark, out).first()) == (8, 8, 0)


def test_counters_of_many_batches(spark, tmp_path):
    """More micro-batches than a query's progress reports reach back (100)."""
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for i in range(110):
        (src / f"{i}.txt").write_text(f"Story: {LONG} {i}\n<|endoftext|>\nStory: short")
    q = inc.build_records_incrementally(spark, str(src), out, checkpoint=str(tmp_path / "ck"), max_files=1)
    assert len(q.recentProgress) < 110
    assert tuple(inc.progress_totals(spark, out).first()) == (110, 110, 0)
    assert spark.read.parquet(out).count() == 110


def test_live_best_equals_batch(spark, sf001, tmp_path):
    log = catalog.train_log(spark, sf001).drop("ts")
    d = str(tmp_path / "log")
    log.write.parquet(d)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(d)
    q = inc.live_best(stream).writeStream.outputMode("complete").format("memory").queryName("live_best").start()
    q.processAllAvailable()
    q.stop()
    live = {r.run: (r.best_loss, r.best_step) for r in spark.sql("SELECT * FROM live_best").collect()}
    batch = metrics.best_so_far(log, "run", "step", "val_loss", ordering.bucket_of("step", 512)).filter("is_best")
    last_best = {}
    for r in batch.orderBy("step").collect():
        last_best[r.run] = (r.val_loss, r.step)
    assert live == last_best


def test_word_count_stream_equals_batch(spark, sf001, tmp_path):
    s = catalog.split_docs(spark, sf001).select("story")
    d = str(tmp_path / "stories")
    s.repartition(3).write.parquet(d)
    stream = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(d)
    q = inc.word_count_stream(stream).writeStream.outputMode("complete").format("memory").queryName("wc").start()
    q.processAllAvailable()
    q.stop()
    live = {r.word: r.freq for r in spark.sql("SELECT * FROM wc").collect()}
    batch = {r.word: r.freq for r in tok.word_counts(tok.pretokenize(s, "story")).collect()}
    assert live == batch
