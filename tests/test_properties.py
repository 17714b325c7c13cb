"""Properties: round trips, split totals, mask sums, partition invariance,
and brute-force references on small fixtures (BPE training and encoding,
stream packing, windows)."""

import os

import pytest
from pyspark.sql import functions as F

from talewright.operators import bpe, ordering, packing
from talewright.operators import tokenizer as tok
from talewright.plans import catalog


def test_char_round_trip(spark, sf001):
    train = catalog.split_docs(spark, sf001).filter(F.col("split") == "train")
    vocab = catalog.char_tokenizer(spark, sf001)
    enc = tok.char_encode(train, vocab, "story", on_oov="error")
    dec = tok.char_decode(enc, vocab, "ids")
    assert dec.filter(F.col("text") != F.col("story")).count() == 0


def test_bpe_round_trip(spark, sf001):
    vocab, merges = catalog.bpe_tokenizer(spark, sf001)
    # train text only: every byte of it is in the alphabet (val bytes may map to [UNK])
    s = catalog.split_docs(spark, sf001).filter(F.col("split") == "train")
    enc = bpe.bpe_encode(s, vocab, merges, ["doc_id", "pos"], "story")
    dec = bpe.bpe_decode(enc, vocab, "ids").join(s, ["doc_id", "pos"])
    assert dec.filter(F.col("text") != F.col("story")).count() == 0
    assert enc.filter(F.element_at("ids", 1) != tok.BOS_ID).count() == 0


def test_split_totals(spark):
    df = spark.range(1234).withColumnRenamed("id", "k")
    out = ordering.ratio_split(df, ["k"], ordering.bucket_of("k", 100), 0.8, 0.1, 0.1)
    assert out.count() == 1234
    assert out.select("k").distinct().count() == 1234


def test_mask_sum(spark, sf001):
    t = catalog.sft_trip(spark, sf001)
    C = catalog.SFT_CONTEXT
    rows = t.select(F.size("full_ids").alias("n"), F.size("prompt_ids").alias("P"),
                    F.aggregate("mask", F.lit(0.0).cast("double"), lambda a, x: a + x).alias("s")).collect()
    assert rows
    for r in rows:
        L = min(r.n, C)
        assert r.s == max(0, L - 1 - max(0, r.P - 1))


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_partition_invariance(spark, sf001, parts, monkeypatch):
    from talewright.plans import inputs
    base = sorted(tuple(r) for r in catalog.q_assemble_records(spark, sf001).collect())
    orig = inputs.read

    def reread(spark_, sf_dir, name):
        return orig(spark_, sf_dir, name).repartition(parts)

    monkeypatch.setattr(inputs, "read", reread)
    monkeypatch.setattr(catalog, "read", reread)
    again = sorted(tuple(r) for r in catalog.q_assemble_records(spark, sf001).collect())
    idx = {r.doc_id: r.idx for r in catalog.q_ordered_index(spark, sf001).collect()}
    assert again == base
    assert sorted(idx.values()) == list(range(len(idx)))


def _bpe_brute(words, n_merges, min_freq=2):
    """One merge per round over (symbols, freq); ranks by (count desc, left, right)."""
    state = {tuple(f"{b:02X}" for b in w.encode()): f for w, f in words}
    merges = []
    for _ in range(n_merges):
        counts = {}
        for syms, f in state.items():
            for a, b in zip(syms, syms[1:]):
                counts[(a, b)] = counts.get((a, b), 0) + f
        if not counts:
            break
        (a, b), c = min(counts.items(), key=lambda kv: (-kv[1], kv[0][0], kv[0][1]))
        if c < min_freq:
            break
        merges.append((a, b, c))
        new = {}
        for syms, f in state.items():
            out, i = [], 0
            while i < len(syms):
                if i + 1 < len(syms) and syms[i] == a and syms[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(syms[i])
                    i += 1
            new[tuple(out)] = new.get(tuple(out), 0) + f
        state = new
    return merges


@pytest.mark.parametrize("first,most,limit", [(1, 1, 20_000), (8, 32, 20_000), (16, 8192, 40), (16, 8192, 20_000)])
def test_bpe_rounds_equal_sequential(spark, sf001, first, most, limit):
    """Many merges a round, few pairs a round, rounds halved by the chain limit:
    always the merges of one-by-one training."""
    words = catalog.train_words(spark, sf001).filter(F.length("word") < 9).cache()
    rows = [(r.word, r.freq) for r in words.collect()]
    n = 10 if most == 1 else 120
    want = _bpe_brute(rows, n)
    vocab, merges = bpe.bpe_train(words, num_merges=n, first_pairs=first, most_pairs=most, chain_limit=limit)
    got = [(r.left_tok, r.right_tok, r["count"]) for r in merges.orderBy("rank").collect()]
    assert got == want
    made = {a + b for a, b, _ in want}
    tokens = [r.token for r in vocab.orderBy("id").collect()]
    assert tokens[:4] == tok.SPECIALS and len(set(tokens)) == len(tokens) and made <= set(tokens)


def test_bpe_train_stops(spark):
    words = spark.createDataFrame([("aaaa", 3), ("ab", 2), ("", 9), ("é", 1)], "word string, freq long")
    vocab, merges = bpe.bpe_train(words, vocab_size=9)
    # a, b and the two bytes of é; one token more fits
    assert [tuple(r) for r in merges.collect()] == [(0, "61", "61", 9)] and vocab.count() == 9
    vocab, merges = bpe.bpe_train(words, vocab_size=100)
    assert [(r.left_tok, r.right_tok, r["count"]) for r in merges.orderBy("rank").collect()] == [("61", "61", 9), ("6161", "6161", 3), ("61", "62", 2)]
    none, merges = bpe.bpe_train(words.limit(0), vocab_size=100)
    assert none.count() == 4 and merges.count() == 0


def _lowest_rank_first(word, ranks):
    syms = [f"{b:02X}" for b in word.encode()]
    while True:
        ranked = [(ranks[p], p) for p in zip(syms, syms[1:]) if p in ranks]
        if not ranked:
            return syms
        a, b = min(ranked)[1]
        out, i = [], 0
        while i < len(syms):
            if i + 1 < len(syms) and syms[i] == a and syms[i + 1] == b:
                out.append(a + b)
                i += 2
            else:
                out.append(syms[i])
                i += 1
        syms = out


def test_bpe_encode_brute(spark, sf001):
    words = catalog.train_words(spark, sf001)
    vocab, merges = bpe.bpe_train(words, num_merges=300)
    ranks = {(r.left_tok, r.right_tok): r["rank"] for r in merges.collect()}
    v = {r.token: r.id for r in vocab.collect()}
    odd = spark.createDataFrame([("",), ("x" * 3000,), ("\u0000\u0085 \U0001F600",), ("the" * 400,)], "word string")
    some = words.select("word").limit(800).union(odd)
    for r in bpe.encode_words(some, vocab, merges, "word", "ids").collect():
        assert r.ids == [v.get(s, tok.UNK_ID) for s in _lowest_rank_first(r.word, ranks)], r.word


def test_bpe_cost_does_not_follow_the_merge_list(spark, sf001):
    """Encoding with 12 times as many merges takes about the same time."""
    import time
    words = catalog.train_words(spark, sf001).select("word").cache()
    vocab, merges = bpe.bpe_train(catalog.train_words(spark, sf001), num_merges=1200)

    def seconds(n):
        enc = bpe.encode_words(words, vocab, merges.filter(F.col("rank") < n), "word", "ids")
        enc.write.format("noop").mode("overwrite").save()
        t = time.time()
        enc.write.format("noop").mode("overwrite").save()
        return time.time() - t

    seconds(100)
    assert min(seconds(1200) for _ in range(3)) < 3 * min(seconds(100) for _ in range(3)) + 0.5


def _stream_fixture(spark):
    rows = [("train", i, [i * 10 + j for j in range(n)]) for i, n in enumerate([5, 0, 9, 3, 12, 1])]
    return spark.createDataFrame(rows, "split string, k long, ids array<int>")


@pytest.mark.parametrize("bos_eos", [False, True])
def test_pack_stream_brute(spark, bos_eos):
    df = _stream_fixture(spark)
    blocks = packing.pack_stream(df, ["k"], ordering.bucket_of("k", 2), [-1, -2], block_size=4, bos_eos=bos_eos)
    got = []
    for r in blocks.orderBy("block_id").collect():
        got += r.ids
    want = []
    for r in sorted(df.collect(), key=lambda r: r.k):
        want += r.ids + [-1, -2]
    want = want[:-2]
    if bos_eos:
        want = [tok.BOS_ID] + want + [tok.EOS_ID]
    assert got == want
    pairs = packing.next_token_pairs(blocks, block_size=4).orderBy("gpos").collect()
    assert [(p.token, p.next_token) for p in pairs] == list(zip(want, want[1:]))


def test_window_batch_brute(spark):
    df = _stream_fixture(spark)
    blocks = packing.pack_stream(df, ["k"], ordering.bucket_of("k", 2), [-1, -2], block_size=4)
    stream = []
    for r in blocks.orderBy("block_id").collect():
        stream += r.ids
    sizes = spark.createDataFrame([("train", len(stream))], "split string, n_tokens long")
    draws = spark.range(20).select(F.lit("train").alias("split"), F.col("id").alias("draw"), F.lit(7).alias("seed"),
                                   F.lit(5).alias("context_length"))
    w = packing.window_batch(blocks, draws, sizes, 4).collect()
    assert len(w) == 20
    for r in w:
        assert 0 <= r.start < len(stream) - 5
        assert r.x == stream[r.start:r.start + 5] and r.y == stream[r.start + 1:r.start + 6]


def test_tokenizer_save_load(spark, tmp_path):
    from talewright.sources import records
    vocab = spark.createDataFrame([(0, "[PAD]"), (4, "41")], "id int, token string")
    merges = spark.createDataFrame([(0, "41", "42", 3)], "rank int, left_tok string, right_tok string, count long")
    records.save_tokenizer(vocab, merges, str(tmp_path / "tok"))
    v2, m2 = records.load_tokenizer(spark, str(tmp_path / "tok"))
    assert sorted(map(tuple, v2.collect())) == sorted(map(tuple, vocab.collect()))
    assert [tuple(r) for r in m2.collect()] == [(0, "41", "42", 3)]


def test_write_sft_counts(spark, tmp_path):
    from talewright.sources import records
    df = spark.createDataFrame([("train", "p", "r é"), ("train", "", "r"), ("test", "p2", "")], "split string, prompt string, response string")
    out = str(tmp_path / "sft")
    counts = records.write_sft(df, out)
    assert counts == {"processed": 3, "written": 1, "skipped": 2}
    back = records.read_sft(spark, out + "/split=train").collect()
    assert [(r.prompt, r.response) for r in back] == [("p", "r é")]
    text = "".join(open(os.path.join(out, "split=train", f), encoding="utf-8").read()
                   for f in os.listdir(os.path.join(out, "split=train")) if f.endswith(".json"))
    assert "é" in text      # non-ASCII kept
    empty = records.write_sft(df.limit(0), str(tmp_path / "empty"))
    assert empty == {"processed": 0, "written": 0, "skipped": 0}
    # mode ignore: an existing output is left as it is
    records.write_sft(df, out, mode="ignore")


def test_write_stories(spark, tmp_path):
    from talewright.sources import records
    df = spark.createDataFrame([("train", 1, "b"), ("train", 0, "a"), ("val", 2, "c")], "split string, k long, story string")
    out = str(tmp_path / "stories")
    records.write_stories(df, out, ["k"])
    got = spark.read.text(out + "/split=train", lineSep="\n\n").collect()
    assert [r.value for r in got] == ["a", "b"]


def test_triplets_and_log_round_trip(spark, tmp_path):
    from talewright.sources import logs, records
    trip = spark.createDataFrame([(1, 0, "train", [2, 5], [5, 0], [1.0, 0.0])],
                                 "conv_id long, turn long, split string, tokens array<int>, targets array<int>, mask array<float>")
    records.write_triplets(trip, str(tmp_path / "trip"))
    assert spark.read.parquet(str(tmp_path / "trip")).count() == 1
    runs = spark.createDataFrame(
        [(s, 1000, "ckpt", l, p) for s, l, p in [(1337, 0.775700, 2.172113), (42, 0.770475, 2.160794), (7, 0.773101, 2.166473)]],
        "seed int, params long, checkpoint string, val_loss double, val_perplexity double")
    for m in logs.METRIC_NAMES:
        runs = runs.withColumn(f"train_{m}", F.lit(1.0)).withColumn(f"val_{m}", F.col("val_loss") if m == "loss" else F.lit(1.0))
    runs = runs.withColumn("samples", F.array(F.struct(F.lit("Once").alias("prompt"), F.lit("same").alias("text"))))
    summary = logs.summary_log(runs, "seed_sweep", "latest.npz")
    path = logs.write_benchmark_log(summary, str(tmp_path / "bench"), "seed_sweep")
    assert os.path.basename(path).endswith("_seed_sweep")
    back = logs.read_benchmark_logs(spark, path)
    assert back.count() == 3
    r = spark.read.json(path).collect()[0]
    assert abs(r.val_loss_mean - 0.773092) < 1e-6 and abs(r.val_loss_std - 0.002133) < 1e-6
    s, distinct = logs.explode_samples(back.withColumn("samples", F.array(F.struct(F.lit("Once").alias("prompt"), F.lit("same").alias("text")))))
    assert distinct.collect()[0].distinct_texts == 1


@pytest.mark.parametrize("agg", ["sum", "min", "max"])
def test_running_agg_levels_brute(spark, agg):
    import random
    rng = random.Random(3)
    rows = [(g, k, rng.randint(-50, 50)) for g in ("a", "b") for k in rng.sample(range(5000), 700)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    from talewright.operators import ordering as o
    old = o.FANOUT
    o.FANOUT = 4
    try:
        got = {(r.g, r.k): r.running for r in o.running_agg(
            df, "v", ["k"], o.bucket_of("k", 16), ["g"], inclusive=False, agg=agg, levels=3, total_col="tot").collect()}
    finally:
        o.FANOUT = old
    fn = {"sum": sum, "min": min, "max": max}[agg]
    for g in ("a", "b"):
        seq = sorted((k, v) for gg, k, v in rows if gg == g)
        for i, (k, _) in enumerate(seq):
            prev = [v for _, v in seq[:i]]
            want = (fn(prev) if prev else (0 if agg == "sum" else None))
            assert got[(g, k)] == want


def test_lookups_at_any_size(spark):
    """Characters of all planes and a vocabulary of 100,000 entries, by the one
    path: equal to a dictionary."""
    import random
    rng = random.Random(4)
    points = [p for p in rng.sample(range(1, 0x110000), 60_000) if not 0xD800 <= p < 0xE000] + list(range(1, 300))
    tokens = sorted({chr(p) for p in points})
    vocab = spark.createDataFrame(list(enumerate(tokens)), "id int, token string")
    known = {t: i for i, t in enumerate(tokens)}
    texts = ["".join(rng.choice(tokens) for _ in range(rng.randint(0, 60))) for _ in range(200)] + ["", chr(0x10FFFF) * 2]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, story string")
    got = {r.k: (r.ids, r.n_oov) for r in tok.char_encode(df, vocab, on_oov="flag").collect()}
    for k, t in enumerate(texts):
        assert got[k] == ([known[c] for c in t if c in known], sum(c not in known for c in t))
    enc = tok.char_encode(df, vocab, on_oov="unk")
    back = {r.k: r.text for r in tok.char_decode(enc, vocab).collect()}
    assert back == {k: "".join(c if c in known else tok.REPLACEMENT for c in t) for k, t in enumerate(texts)}
    with pytest.raises(Exception, match="not in vocabulary"):
        tok.char_encode(df, vocab.filter("id > 5000")).collect()
