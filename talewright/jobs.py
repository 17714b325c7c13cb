"""End-to-end jobs: the reference's scripts as compositions of the
operators, reading and writing files.

* :func:`prepare_stories`   story files (+ JSON fallback) -> train / val story text
* :func:`prepare_sft`       instruction line files -> split SFT JSON Lines
* :func:`train_tokenizer`   story text -> byte-level BPE tables
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import blocks, bpe, metrics, ordering, sampling
from .operators import tokenizer as tok
from .session import cut_lineage
from .sources import records, stories

MAX_TRAIN_STORIES, MAX_VAL_STORIES = 20000, 2000
BYTE_BUDGET = 50 * 1024 * 1024
JSON_LINE_BUCKET = 4096


def _text_stories(spark: SparkSession, path: str) -> DataFrame:
    """Stories of ``.txt`` files, routed by file name, cut to the first
    ``BYTE_BUDGET`` raw bytes of each file and capped per file. Order key inside a file: (block_start, pos); a file
    split (``block_start``) is the prefix-scan bucket (bounded by the split size)."""
    name = F.regexp_extract(F.col("file"), "[^/]*$", 0)      # route on the file name, not its folders
    t = stories.read_pieces(spark, path).withColumn("split", stories.route_split(name)).filter(
        F.col("split").isNotNull() & (F.col("block_start") < BYTE_BUDGET))
    t = ordering.byte_budget(t, "file", ["block_start", "pos"], F.col("block_start"), BYTE_BUDGET,
                             text_col="value", out="story").drop("value")
    capped = None
    for split, cap in (("train", MAX_TRAIN_STORIES), ("val", MAX_VAL_STORIES)):
        part = ordering.per_source_cap(t.filter(F.col("split") == split), "file", ["block_start", "pos"], cap).drop("rank")
        capped = part if capped is None else capped.unionByName(part)
    return capped.select("split", "file", F.col("block_start").alias("o1"), F.col("pos").alias("o2"), "story")


def _json_stories(spark: SparkSession, path: str, n_train: int, n_val: int) -> DataFrame:
    """JSON stories in file order, global fill: train first, then val."""
    j = stories.read_json_stories(spark, path)
    bucket = F.struct("file", ordering.bucket_of("line_no", JSON_LINE_BUCKET))
    j = ordering.fill_order_split(j, ["file", "line_no", "item_pos"], bucket, n_train, n_val)
    return j.select("split", "file", F.col("line_no").alias("o1"), F.col("item_pos").alias("o2"), "story")


def prepare_stories(spark: SparkSession, text_path: str | None, json_path: str | None, out_dir: str,
                    mode: str = "once") -> DataFrame:
    """Extract train / val stories (SRC1-SRC7, SNK1, SNK3): text files first;
    JSON members only if the text files gave no train story. Written as one
    text output per split with a blank line after every story; an existing
    output is left as it is (``mode="once"``). Returns the stories."""
    parts = []
    if text_path:
        parts.append(_text_stories(spark, text_path))
    if json_path:
        # what the text files gave to val counts against its cap
        given = parts[0].filter(F.col("split") == "val").count() if parts else 0
        parts.append(_json_stories(spark, json_path, MAX_TRAIN_STORIES, max(0, MAX_VAL_STORIES - given)))
    if not parts:
        raise ValueError("no input")
    out = parts[0] if len(parts) == 1 else stories.read_with_fallback(parts[0], parts[1])
    records.write_stories(out, out_dir, ["file", "o1", "o2"], mode=mode, text_col="story")
    return out


def prepare_sft(spark: SparkSession, lines_path: str, out_dir: str, seed: int = 1337, train: float = 0.90,
                test: float = 0.05, holdout: float = 0.05, max_samples: int | None = None,
                mode: str = "errorifexists") -> dict:
    """Instruction data (BLK1-BLK3, AGG1-AGG2, SMP1-SMP3, SNK2): line files
    -> blocks -> records -> optional exact seeded sample -> prefix split ->
    JSON Lines per split. Returns the profile and write counts."""
    ordering.check_ratios(train, test, holdout)
    raw = spark.read.text(lines_path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("pos"), F.col("value").alias("text"))
    raw = raw.withColumn("ord", F.struct("block_start", "pos"))
    blocked = blocks.assign_blocks(raw, "file", ["block_start", "pos"], F.col("block_start"))
    recs = blocks.assemble_records(blocked, ["file", "block"], "ord").select("file", "block", "prompt", "response")
    recs = cut_lineage(recs)          # the records feed the profile, the sample and the write
    profile = metrics.corpus_profile(raw, recs).collect()[0].asDict()
    profile["unique_prompts"] = metrics.prompt_diversity(recs).collect()[0][0]
    if max_samples is not None and max_samples < profile["records"]:
        ranked = sampling.sample_n(recs, ["file", "block"], max_samples, seed,
                                   order_bucket=F.struct("file", ordering.bucket_of("block", 1 << 16)))
        order, bucket = ["sample_rank"], ordering.bucket_of("sample_rank", 1 << 16)
    else:
        ranked, order = recs, ["file", "block"]
        bucket = F.struct("file", ordering.bucket_of("block", 1 << 16))
    split = ordering.ratio_split(ranked, order, bucket, train, test, holdout)
    counts = records.write_sft(split, out_dir, mode=mode)
    return {**profile, **counts}


def train_tokenizer(spark: SparkSession, train_path: str, out_dir: str, vocab_size: int = 4096,
                    min_frequency: int = 2, mode: str = "errorifexists") -> tuple[DataFrame, DataFrame]:
    """Byte-level BPE from a text file read line by line (TOK4-TOK9, SNK4):
    each line is pre-tokenized on its own, words are counted, merges learned
    until ``vocab_size``; saved as vocab and merges tables."""
    lines = spark.read.text(train_path).select(F.col("value").alias("line"))
    words = tok.word_counts(tok.pretokenize(lines, "line"))
    vocab, merges = bpe.bpe_train(words, vocab_size=vocab_size, min_frequency=min_frequency)
    records.save_tokenizer(vocab, merges, out_dir, mode=mode)
    return vocab, merges
