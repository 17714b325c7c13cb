"""Hand-made rows of FIXTURES.md: every quirk of the reference rules."""

import math

import pytest
from pyspark.sql import functions as F

from talewright.operators import bpe
from talewright.operators import tokenizer as tok
from talewright.operators import blocks, metrics, ordering, packing, scores, sweeps
from talewright.sources import stories


def test_story_text_split(spark):
    df = spark.createDataFrame([(1, "a one\n\n\nb two\nb2\n\n  \n\nc")], "id long, text string")
    got = [r.story for r in stories.split_stories(df, "text", "\n\n").orderBy("pos").collect()]
    assert got == ["a one", "b two\nb2", "c"]


def test_story_text_file(spark, tmp_path):
    p = tmp_path / "train.txt"
    p.write_text("a one\n\n\nb two\nb2\n\n  \n\nc")
    got = [r.story for r in stories.read_stories(spark, str(p)).orderBy("pos").collect()]
    assert got == ["a one", "b two\nb2", "c"]


@pytest.mark.parametrize("js,expected", [
    ('["a ", "", {"story":"z"}, 3]', ["a", "z"]),
    ('{"text":"hi","story":"no"}', ["hi"]),
    ('{"text":"","story":"yo"}', []),
    ('{"other":1}', []),
    ('{"text":" x "}', [" x "]),
    ('"just a string"', []),
    ('bad{', []),
])
def test_json_shapes(spark, js, expected):
    df = spark.createDataFrame([(1, js)], "id long, json string")
    got = [r.story for r in stories.json_stories(df, "json").orderBy("item_pos").collect()]
    assert got == expected


def test_json_lines_file(spark, tmp_path):
    p = tmp_path / "data.jsonl"
    p.write_text('{"text":"x"}\n\nbad{\n["y"]\n')
    got = sorted(r.story for r in stories.read_json_stories(spark, str(p)).collect())
    assert got == ["x", "y"]


def test_json_whole_file(spark, tmp_path):
    p = tmp_path / "data.json"
    p.write_text('[\n  {"text": "one"},\n  "two "\n]\n')
    got = sorted(r.story for r in stories.read_json_stories(spark, str(p)).collect())
    assert got == ["one", "two"]


def test_route_split(spark):
    df = spark.createDataFrame([("x/TRAIN_valid.txt",), ("valid-1.txt",), ("test.txt",)], "p string")
    got = [r.s for r in df.select(stories.route_split("p").alias("s")).collect()]
    assert got == ["train", "val", None]


def test_format_fallback(spark):
    prim = spark.createDataFrame([("val", "p")], "split string, story string")
    sec = spark.createDataFrame([("train", "s")], "split string, story string")
    assert sorted(r.story for r in stories.read_with_fallback(prim, sec).collect()) == ["p", "s"]
    prim2 = spark.createDataFrame([("train", "p")], "split string, story string")
    assert [r.story for r in stories.read_with_fallback(prim2, sec).collect()] == ["p"]


def _records(spark, lines):
    rows = [("f", i, t) for i, t in enumerate(lines)]
    df = spark.createDataFrame(rows, "src string, line_no long, text string")
    b = blocks.assign_blocks(df, "src", ["line_no"], ordering.bucket_of("line_no", 3))
    return [(r.prompt, r.response) for r in blocks.assemble_records(b, ["src", "block"], "line_no").orderBy("first_line").collect()]


LONG = "Once upon a time there was a girl named Lily."   # >= 40 characters


def test_block_full_example(spark):
    lines = ["Features: Dialogue", "Words: quit, oak", "Summary: S", "Story:", "", "Lily wanted to quit.",
             "The oak tree was very tall and old.", "<|endoftext|>"]
    got = _records(spark, lines)
    assert got == [("Write a short story with features: Dialogue, using the words: quit, oak, about: S.",
                    "Lily wanted to quit. The oak tree was very tall and old.")]


def test_block_rules(spark):
    lines = [
        "stray", "Story: first " + LONG, "<|endoftext|>",            # stray ignored, remainder opens story
        "WORDS: a", "story:", LONG, "<|endoftext|>",                 # case-insensitive prefix
        "Story:", "Words: later", LONG, "<|endoftext|>",             # header-like line is a constraint
        "Words: a", "<|endoftext|>",                                 # no story -> no record
        "Story:", "x" * 39, "<|endoftext|>",                         # 39 chars -> dropped
        "Story:", "y" * 40, "<|endoftext|>",                         # 40 chars -> kept
        "<|endoftext|>",                                             # two delimiters -> no empty record
        "  Story:  ", "Words:", LONG,                                # no trailing delimiter -> kept
    ]
    got = _records(spark, lines)
    assert got == [
        ("Write a short story.", "first " + LONG),
        ("Write a short story using the words: a.", LONG),
        ("Write a short story using the words: later.", LONG),
        ("Write a short story.", "y" * 40),
        ("Write a short story using the words: .", LONG),
    ]


def test_block_records_match_batch(spark):
    lines = ["stray", "Story: first " + LONG, "<|endoftext|>", "WORDS: a", "story:", LONG, "<|endoftext|>",
             "Words: a", "<|endoftext|>", "Story:", "y" * 40]
    df = spark.createDataFrame([(b,) for b in "\n".join(lines).split("<|endoftext|>")], "value string")
    got = [(r.prompt, r.response) for r in blocks.block_records(df).select("prompt", "response").collect()]
    assert got == _records(spark, lines)


@pytest.mark.parametrize("n,expected", [(100, (90, 5, 5)), (10, (9, 0, 1)), (1, (0, 0, 1)), (0, (0, 0, 0))])
def test_ratio_split(spark, n, expected):
    df = spark.range(n).withColumnRenamed("id", "k")
    out = ordering.ratio_split(df, ["k"], ordering.bucket_of("k", 7), 0.90, 0.05, 0.05)
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert (counts.get("train", 0), counts.get("test", 0), counts.get("holdout_test", 0)) == expected


def test_ratio_check():
    with pytest.raises(ValueError):
        ordering.check_ratios(0.9, 0.05, 0.06)


@pytest.mark.parametrize("L,P,compat,expected", [
    (6, 3, True, [0, 0, 1, 1, 1, 0, 0, 0]),
    (6, 3, False, [0, 1, 1, 1, 1, 0, 0, 0]),
    (12, 3, True, [0, 0, 1, 1, 1, 1, 1, 0]),
    (12, 3, False, [0, 1, 1, 1, 1, 1, 1, 0]),
    (12, 9, True, [0] * 8),
    (12, 9, False, [0] * 8),
])
def test_loss_mask(spark, L, P, compat, expected):
    df = spark.createDataFrame([(L, P)], "L int, P int")
    got = df.select(packing.loss_mask("L", "P", 8, compat).alias("m")).collect()[0].m
    assert [int(x) for x in got] == expected


def test_targets(spark):
    df = spark.createDataFrame([([2, 7, 8, 9, 3],)], "ids array<int>")
    r = df.select(packing.shift_targets("ids", 8).alias("t"), packing.truncate_pad("ids", 8).alias("p")).collect()[0]
    assert r.t == [7, 8, 9, 3, 0, 0, 0, 0]
    assert r.p == [2, 7, 8, 9, 3, 0, 0, 0]


@pytest.mark.parametrize("k,kept", [(2, [3.0, 2.0, 2.0]), (10, [3.0, 2.0, 2.0, 1.0])])
def test_top_k(spark, k, kept):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate([3.0, 2.0, 2.0, 1.0])], "ctx_id long, token_id int, logit double")
    got = sorted((r.logit for r in scores.top_k_filter(df, k).filter("kept").collect()), reverse=True)
    assert got == kept


@pytest.mark.parametrize("signed,expected", [(False, [2.0, -1.0]), (True, [2.0, -1.69])])
def test_repetition_penalty(spark, signed, expected):
    sc = spark.createDataFrame([(0, 1, 2.6), (0, 2, -1.3), (0, 3, 5.0)], "ctx_id long, token_id int, logit double")
    hist = spark.createDataFrame([(0, 1), (0, 2), (0, 2)], "ctx_id long, token_id int")
    got = {r.token_id: r.logit for r in scores.repetition_penalty(sc, hist, 1.3, signed).collect()}
    assert [round(got[1], 6), round(got[2], 6)] == expected and got[3] == 5.0


def test_best_so_far(spark):
    log = spark.createDataFrame([("r", i, v) for i, v in enumerate([2.0, 1.5, 1.5, 1.4])], "run string, step long, val_loss double")
    got = [r.is_best for r in metrics.best_so_far(log, "run", "step", "val_loss", ordering.bucket_of("step", 2)).orderBy("step").collect()]
    assert got == [True, True, False, True]


def test_eval_points(spark):
    log = spark.range(1200).select(F.lit("r").alias("run"), F.col("id").alias("step"))
    got = [r.step for r in metrics.eval_points(log, "run", "step", 500).orderBy("step").collect()]
    assert got == [0, 500, 1000, 1199]


def test_masked_loss_all_zero(spark):
    df = spark.createDataFrame([(1.5, 0.0), (2.0, 0.0)], "loss double, mask double")
    assert df.agg(metrics.masked_mean("loss", "mask").alias("m")).collect()[0].m == 0.0


def test_sweep_grid(spark):
    g = sweeps.sweep_grid(spark, "1337, 42,,7", "", "").orderBy("run_order").collect()
    assert [(r.seed, r.d_model, r.context_length) for r in g] == [(1337, None, None), (42, None, None), (7, None, None)]


def test_config_override(spark):
    g = sweeps.apply_overrides(sweeps.sweep_grid(spark, "7", "", "64"), {"d_model": 96, "context_length": 128})
    r = g.collect()[0]
    assert (r.seed, r.d_model, r.context_length) == (7, 96, 64)


def test_seed_stability_published(spark):
    # The published char-model seed sweep (val loss of seeds 1337, 42, 7; mean; population std).
    runs = spark.createDataFrame([(0.775700, 2.172113), (0.770475, 0.0), (0.773101, 0.0)], "val_loss double, val_perplexity double")
    r = metrics.seed_stability(runs).collect()[0]
    assert math.isclose(r.val_loss_mean, 0.773092, abs_tol=1e-6)
    assert math.isclose(r.val_loss_std, 0.002133, abs_tol=1e-6)


def test_pick_checkpoint():
    assert metrics.pick_checkpoint(["latest", "best"]) == "best"
    assert metrics.pick_checkpoint(["latest"]) == "latest"
    assert metrics.pick_checkpoint([]) is None


def test_json_trailing_content(spark, tmp_path):
    p = tmp_path / "bad.json"
    p.write_text('{"a": {"text":\n"q"}} trailing\n')
    assert stories.read_json_stories(spark, str(p)).count() == 0


def test_chat_pairs_with_gaps(spark):
    """The turn just before counts, whatever its number; also across buckets."""
    rows = [(1, 1, "user", "q1"), (1, 3, "assistant", "a1"), (1, 4, "assistant", "a2"), (1, 1023, "user", "q2"), (1, 5000, "assistant", "a3"),
            (2, 0, "assistant", "first"), (3, 2047, "user", "q3"), (3, 2048, "system", "s"), (3, 2049, "assistant", "a4")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, blocks.chat_pairs(df).collect())) == [(1, 3, "q1", "a1"), (1, 5000, "q2", "a3")]


def test_bpe_encode_keeps_empty_texts(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "k long, story string")
    vocab, merges = bpe.bpe_train(spark.createDataFrame([("a", 5)], "word string, freq long"), vocab_size=8)
    got = {r.k: r.ids for r in bpe.bpe_encode(df, vocab, merges, ["k"]).collect()}
    assert got == {1: [tok.BOS_ID, 4, tok.EOS_ID], 2: [tok.BOS_ID, tok.EOS_ID], 3: [tok.BOS_ID, tok.EOS_ID]}


def test_pretokenize_unicode_white_space(spark):
    df = spark.createDataFrame([("a\u00a0b\u3000\u3000c \u0085d",)], "story string")
    assert tok.pretokenize(df, "story").first().words == ["a", "\u00a0", "b", "\u3000", "\u3000", "c", " ", "\u0085", "d"]


def test_unknown_characters_keep_an_id(spark):
    vocab = spark.createDataFrame([(0, "a"), (1, "b")], "id int, token string")
    df = spark.createDataFrame([(1, "axb")], "k long, story string")
    enc = tok.char_encode(df, vocab, "story", on_oov="unk")
    assert enc.first().ids == [0, 2, 1]
    assert tok.char_decode(enc, vocab, "ids").first().text == "a\ufffdb"


def test_sparse_scores_equal_dense(spark):
    """Loss, arg max, top-k and the full rows of sparse tables, with ties, full
    and empty contexts, and floors above seen scores, against a dense table."""
    import random

    from talewright.operators.sparse_scores import SparseScores

    rng, V = random.Random(6), 7
    seen, floors, dense = [], [], {}
    for c in range(40):
        ids = rng.sample(range(V), rng.choice([0, 1, 3, V - 1, V]))
        floor = rng.choice([-2.0, -1.0, -0.5])
        row = {t: rng.choice([-3.0, -2.0, -1.0, -0.5, -0.25]) for t in ids}
        seen += [(c, t, x) for t, x in row.items()]
        floors.append((c, floor, V - len(ids)))
        dense[c] = [row.get(t, floor) for t in range(V)]
    s = SparseScores(spark.createDataFrame(seen, "ctx_id int, token_id int, logit double"),
                     spark.createDataFrame(floors, "ctx_id int, floor double, rest int"), V)
    for r in s.argmax().collect():
        assert r.pred == dense[r.ctx_id].index(max(dense[r.ctx_id]))
    for k in (1, 3, V, V + 5):
        got = {r.ctx_id: r.cut for r in s.cuts(k).collect()}
        assert got == {c: sorted(x, reverse=True)[min(k, V) - 1] for c, x in dense.items()}
    targets = spark.createDataFrame([(c, t) for c in dense for t in range(V)] + [(99, 0), (0, V)], "ctx_id int, target int")
    rows = {(r.ctx_id, r.target): r.nll for r in s.token_nll(targets).collect()}
    assert rows.pop((99, 0)) is None and rows.pop((0, V)) is None
    for (c, t), nll in rows.items():
        assert abs(nll - (math.log(sum(map(math.exp, dense[c]))) - dense[c][t])) < 1e-12
    ctx = spark.createDataFrame([("p", 3), ("q", 3), ("r", 39)], "name string, last int")
    got = {(r.name, r.token_id): r.logit for r in s.of_contexts(ctx, "name", "last").collect()}
    assert got == {(n, t): dense[c][t] for n, c in (("p", 3), ("q", 3), ("r", 39)) for t in range(V)}


def test_sparse_scores_of_counts_sum_to_one(spark):
    from talewright.operators import ngram
    from talewright.operators.sparse_scores import SparseScores

    pairs = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (2, 0)], "token int, next_token int")
    s = SparseScores.of_counts(ngram.ngram_fit(pairs, 4, 1.0), 4, 1.0)
    assert s.seen.count() == 3 and s.floors.count() == 4
    assert all(abs(r.lse) < 1e-12 for r in s.log_sums().collect())


def test_json_line_with_more_than_one_value(spark, tmp_path):
    from talewright.sources import stories

    (tmp_path / "x.jsonl").write_text('{"text":"a"} {"text":"b"}\n{"text":"c"}\n1] [2\n["d", "e"] \n{"text":"f"},')
    got = [r.story for r in stories.read_json_stories(spark, str(tmp_path)).orderBy("line_no", "item_pos").collect()]
    assert got == ["c", "d", "e"]


def test_sample_keeps_all_in_buckets(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    from talewright.operators import sampling

    out = sampling.sample_n(df, ["k"], 9999, 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert [r.sample_rank for r in out.orderBy("k").collect()] == list(range(5000))
    assert "windowspecdefinition(k" not in plan          # no window over raw rows without a partition


def test_struct_buckets_are_scanned_in_levels(spark):
    from talewright.operators import ordering

    df = spark.range(3000).select((F.col("id") % 3).cast("string").alias("file"), F.col("id").alias("line"))
    bucket = F.struct("file", ordering.bucket_of("line", 2))
    got = ordering.ordered_index(df, ["file", "line"], bucket, out="i").orderBy("file", "line").collect()
    assert [r.i for r in got] == list(range(3000))


def test_block_records_are_linear(spark):
    import time

    def seconds(lines):
        text = "Story:\n" + "\n".join(f"line {i} of the story" for i in range(lines))
        df = spark.createDataFrame([(text,)] * 4, "value string")
        t = time.time()
        df = blocks.block_records(df)
        df.write.format("noop").mode("overwrite").save()
        return time.time() - t

    seconds(500)
    assert seconds(2_000) < 20 and seconds(8_000) < 20        # fails fast if the work grows with the square
    small, large = min(seconds(20_000) for _ in range(3)), min(seconds(80_000) for _ in range(3))
    assert large < 8 * small + 1
