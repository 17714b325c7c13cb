"""End-to-end jobs on small files."""

import json
import os

from pyspark.sql import functions as F

from talewright import jobs

LONG = "Once upon a time there was a girl named Lily."


def _read_split(spark, out, split):
    return [r.value for r in spark.read.text(os.path.join(out, f"split={split}"), lineSep="\n\n").collect()]


def test_prepare_stories_text(spark, tmp_path, monkeypatch):
    d = tmp_path / "in"
    d.mkdir()
    (d / "TRAIN_part.txt").write_text("t1\n\n\n t2 \n\n  \n\nt3\n\nt4")
    (d / "valid.txt").write_text("v1\n\nv2\n\nv3")
    (d / "test.txt").write_text("x1")
    monkeypatch.setattr(jobs, "MAX_TRAIN_STORIES", 3)
    monkeypatch.setattr(jobs, "MAX_VAL_STORIES", 2)
    out = str(tmp_path / "out")
    jobs.prepare_stories(spark, str(d), None, out)
    assert _read_split(spark, out, "train") == ["t1", "t2", "t3"]
    assert _read_split(spark, out, "val") == ["v1", "v2"]
    # outputs exist: a second run leaves them
    jobs.prepare_stories(spark, str(d), None, out)
    assert _read_split(spark, out, "train") == ["t1", "t2", "t3"]


def test_prepare_stories_json_fallback(spark, tmp_path, monkeypatch):
    d = tmp_path / "txt"
    d.mkdir()
    (d / "valid.txt").write_text("only val")
    j = tmp_path / "json"
    j.mkdir()
    (j / "a.json").write_text(json.dumps(["s1 ", {"text": "s2"}, {"story": "s3"}, "s4"]))
    monkeypatch.setattr(jobs, "MAX_TRAIN_STORIES", 2)
    monkeypatch.setattr(jobs, "MAX_VAL_STORIES", 1)
    out = str(tmp_path / "out")
    got = jobs.prepare_stories(spark, str(d), str(j), out)
    assert sorted((r.split, r.story) for r in got.collect()) == [("train", "s1"), ("train", "s2"), ("val", "only val")]


def test_prepare_sft(spark, tmp_path):
    lines = []
    for i in range(40):
        lines += [f"Features: F{i % 3}", "Words: a, b", "Summary: S", "Story:", "", f"{LONG} {i}", "<|endoftext|>"]
    lines += ["Words: only", "<|endoftext|>"]
    p = tmp_path / "instruct.txt"
    p.write_text("\n".join(lines))
    res = jobs.prepare_sft(spark, str(p), str(tmp_path / "sft"))
    assert res["records"] == 40 and res["unique_prompts"] == 3 and res["written"] == 40 and res["raw_rows"] == len(lines)
    back = spark.read.json(str(tmp_path / "sft"))
    counts = {r.split: r["count"] for r in back.groupBy("split").count().collect()}
    assert counts == {"train": 36, "test": 2, "holdout_test": 2}
    res2 = jobs.prepare_sft(spark, str(p), str(tmp_path / "sft2"), max_samples=10)
    assert res2["written"] == 10
    assert {r.split: r["count"] for r in spark.read.json(str(tmp_path / "sft2")).groupBy("split").count().collect()} == \
        {"train": 9, "holdout_test": 1}


def test_train_tokenizer(spark, tmp_path):
    p = tmp_path / "train.txt"
    p.write_text("\n".join([LONG, "The cat sat on the mat.", "", LONG + " Again."] * 5))
    vocab, merges = jobs.train_tokenizer(spark, str(p), str(tmp_path / "tok"), vocab_size=60)
    assert vocab.count() == 60
    v2 = spark.read.parquet(str(tmp_path / "tok" / "vocab"))
    assert v2.filter(F.col("id") < 4).orderBy("id").select("token").rdd.flatMap(lambda r: r).collect() == \
        ["[PAD]", "[UNK]", "[BOS]", "[EOS]"]


def test_mixed_folder_and_raw_bytes(spark, tmp_path, monkeypatch):
    """JSON members are no text members; the budget counts raw bytes."""
    d = tmp_path / "in"
    d.mkdir()
    (d / "train.json").write_text(json.dumps(["j1", "j2"]))
    (d / "valid.txt").write_text("v1\n\n   \n\nv2\n\nv3")
    monkeypatch.setattr(jobs, "BYTE_BUDGET", 11)
    got = jobs.prepare_stories(spark, str(d), str(d), str(tmp_path / "out"))
    assert sorted((r.split, r.story) for r in got.collect()) == [("train", "j1"), ("train", "j2"), ("val", "v1"), ("val", "v2")]
