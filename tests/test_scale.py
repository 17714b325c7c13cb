"""What must not travel: caches and wide rows that grow with the input."""

import pytest
from pyspark.sql import functions as F

from talewright.functions.text import chars_of
from talewright.operators import bpe, ordering, packing
from talewright.operators import tokenizer as tok
from talewright.plans import catalog


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df):
    """The output columns of everything that is shuffled."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.initialPlan())
        if "Exchange" in node.nodeName():
            found.append(node.output().mkString(" "))
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found


def _bytes_shuffled(df):
    """What the exchanges of a plan wrote, once each."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        elif name != "ReusedExchange":
            total += node.metrics().apply("dataSize").value() if name == "Exchange" else 0
            kids = node.children()
            todo += [kids.apply(i) for i in range(kids.size())]
    return total


def test_chars_are_code_points(spark):
    df = spark.createDataFrame([(1, "aé\U0001f600\n "), (2, ""), (3, None)], "k int, t string")
    got = {r.k: r.c for r in df.select("k", chars_of("t").alias("c")).collect()}
    assert got == {1: ["a", "é", "\U0001f600", "\n", " "], 2: [], 3: None}


def test_text_stream_equals_id_stream(spark):
    rows = [(k, "train" if k % 3 else "val", "".join(chr(97 + (k * j) % 7) for j in range(k % 5 + 1)) + "\U0001f600") for k in range(40)]
    text = spark.createDataFrame(rows, "k long, split string, story string")
    ids = text.withColumn("ids", F.transform(chars_of("story"), lambda c: F.ascii(c))).drop("story")
    args = (["k"], ordering.bucket_of("k", 4))
    want = {(r.split, r.block_id): r.ids for r in packing.pack_stream(ids, *args, [10, 10], block_size=4).collect()}
    packed = packing.pack_stream(text, *args, "\n\n", block_size=4, ids_col="story")
    got = {(r.split, r.block_id): [ord(c) for c in r.story] for r in packed.collect()}
    assert got == want
    with pytest.raises(ValueError):
        packing.pack_stream(text, *args, "\n\n", ids_col="story", bos_eos=True)


def test_text_stream_with_ends_equals_id_stream(spark):
    rows = [(k, "train" if k % 3 else "val", "".join(chr(97 + (k * j) % 7) for j in range(k % 5))) for k in range(40)]
    text = spark.createDataFrame(rows, "k long, split string, story string")
    ids = text.withColumn("ids", F.transform(chars_of("story"), lambda c: F.ascii(c))).drop("story")
    args = (["k"], ordering.bucket_of("k", 4))
    want = {(r.split, r.block_id): r.ids for r in packing.pack_stream(ids, *args, [10, 10], block_size=4, bos_eos=True).collect()}
    packed = packing.pack_stream(text, *args, "\n\n", block_size=4, ids_col="story", bos_eos=True, ends=("\x02", "\x03"))
    assert {(r.split, r.block_id): [ord(c) for c in r.story] for r in packed.collect()} == want


def test_stream_text_is_shuffled_once(spark):
    """The texts went to their buckets, and again, cut into pieces, to their blocks.
    Now only the blocks at the ends of a bucket go on."""
    text = spark.createDataFrame([(k, "train", f"{k:08d}" * 250) for k in range(400)], "k long, split string, story string")
    packed = packing.pack_stream(text, ["k"], ordering.bucket_of("k", 100), "\n\n", block_size=1000, ids_col="story")
    alone = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in alone.items():     # as with texts that no task could hold alone
        spark.conf.set(k, v)
    try:
        sent = _bytes_shuffled(packed)
    finally:
        for k in alone:
            spark.conf.unset(k)
    assert 800_000 < sent < 1_200_000
    whole = "\n\n".join(f"{k:08d}" * 250 for k in range(400))
    assert "".join(r.story for r in packed.orderBy("block_id").collect()) == whole


def test_char_stream_caches_nothing(spark, sf001, monkeypatch):
    """The ids of the whole corpus stood in the executors' memory while the
    stream was built."""
    plans = []
    monkeypatch.setattr(catalog, "land_table", lambda df, *a: plans.append(_plan(df)) or df)
    monkeypatch.setattr(catalog, "landed", lambda spark, sf_dir, name, build, cut=True: build())
    catalog.char_stream(spark, sf001)
    assert plans and not any("InMemoryTableScan" in p for p in plans)


def test_char_stream_sorts_text_not_ids(spark, sf001, monkeypatch):
    """The write by split sorted the ids of a task, which are several times their
    text, and spilled them: rows that come in that order are written as they are."""
    landed = []
    monkeypatch.setattr(catalog, "land_table", lambda df, *a: landed.append(df) or df)
    monkeypatch.setattr(catalog, "landed", lambda spark, sf_dir, name, build, cut=True: build())
    catalog.char_stream(spark, sf001)
    order = landed[-1]._jdf.queryExecution().optimizedPlan().outputOrdering()
    assert order.size() == 1 and order.apply(0).child().sql() == "split"


def test_next_token_pairs_shuffle_no_blocks(spark):
    blocks = spark.createDataFrame([("train", 0, [1, 2, 3]), ("train", 1, [4, 5, 6]), ("train", 2, [7]), ("val", 0, [8])],
                                   "split string, block_id long, ids array<int>")
    pairs = packing.next_token_pairs(blocks, block_size=3)
    assert sorted((r.gpos, r.token, r.next_token) for r in pairs.collect()) == [(i, i + 1, i + 2) for i in range(6)]
    pairs.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = _exchanges(packing.next_token_pairs(blocks, block_size=3))
    finally:
        pairs.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sent and not any("ids#" in s for s in sent)


def test_window_batch_shuffles_only_windows(spark):
    blocks = spark.createDataFrame([("train", b, list(range(8 * b, 8 * b + 8))) for b in range(6)], "split string, block_id long, ids array<int>")
    sizes = spark.createDataFrame([("train", 48)], "split string, n_tokens long")
    draws = spark.createDataFrame([("train", i, 7, t) for i in range(50) for t in (3, 10)], "split string, draw long, seed int, context_length int")
    w = packing.window_batch(blocks, draws, sizes, 8)
    rows = w.collect()
    assert len(rows) == 100
    for r in rows:
        assert r.x == list(range(r.start, r.start + r.context_length)) and r.y == [x + 1 for x in r.x]
    assert not any("ids#" in s for s in _exchanges(w))


def test_token_stats_of_counts(spark):
    df = spark.createDataFrame([("x", [1, 2]), ("x", [3]), ("y", [])], "tokenizer string, ids array<int>")
    assert sorted(tok.token_stats(df).collect()) == sorted(
        tok.token_stats(df.select("tokenizer", F.size("ids").alias("n")), n_col="n").collect())


def test_stream_files_grow_with_the_input(spark):
    assert catalog.stream_files(spark.range(10)) == 4
    assert catalog.stream_files(spark.range(10 * catalog.STREAM_DOCS + 1)) == 44


def test_micro_batches_do_not_grow_with_the_input(spark):
    assert [catalog.batch_files(n, 2) for n in (4, 16, 128, 768)] == [2, 8, 32, 32]
    assert catalog.batch_files(4, catalog.STREAM_PARTS) == 1


def test_streamed_records_of_many_batches(spark, sf001, monkeypatch):
    """Four files, one per micro-batch: the records and counters of all."""
    whole, totals = catalog._streamed_records(spark, sf001)
    seen = []
    build = catalog.inc.build_records_incrementally
    monkeypatch.setattr(catalog.inc, "build_records_incrementally", lambda *a, **kw: seen.append(kw["max_files"]) or build(*a, **kw))
    monkeypatch.setattr(catalog, "STREAM_BATCH", 1)
    parts, again = catalog._streamed_records(spark, sf001)
    assert seen == [1] and again.collect() == totals.collect()
    assert sorted(parts.collect()) == sorted(whole.collect())


@pytest.mark.parametrize("name", ["bpe_encode", "token_stats", "tokenizer_files"])
def test_words_of_texts_do_not_travel(spark, sf001, name):
    """Every word of every text was shuffled to its ids, and back to its text."""
    sent = " ".join(_exchanges(catalog.QUERIES[name](spark, sf001)))
    assert not any(f"{c}#" in sent for c in ("word", "wids", "buf", "_parts"))


def test_words_of_the_bpe_stream_do_not_travel(spark, sf001, monkeypatch):
    plans = []
    monkeypatch.setattr(catalog, "land_table", lambda df, *a: plans.extend(_exchanges(df)) or df)
    monkeypatch.setattr(catalog, "landed", lambda spark, sf_dir, name, build, cut=True: build() if name == "bpe_stream" else catalog.train_words(spark, sf_dir))
    catalog.bpe_stream(spark, sf001)
    assert not any(f"{c}#" in " ".join(plans) for c in ("word", "wids"))


def test_encoding_of_repeated_keys(spark):
    """Rows of one key are one text whose tokens go by place, then by ids."""
    vocab, merges = bpe.bpe_train(spark.createDataFrame([("ab", 5), (" ab", 5), ("c", 1)], "word string, freq long"), vocab_size=9)
    df = spark.createDataFrame([(1, "ab c"), (1, "c ab"), (2, "ab"), (None, "c"), (None, "c"), (1, None)], "k long, story string")
    ids = {r.token: r.id for r in vocab.collect()}
    a, b, c, sp, ab = (ids[x] for x in ("61", "62", "63", "20", "6162"))
    first, second = sorted([[ab], [c]]), sorted([[sp, c], [sp, ab]])
    got = {r.k: r.ids for r in bpe.bpe_encode(df, vocab, merges, ["k"]).collect()}
    assert got == {1: [2, *sum(first + second, []), 3], 2: [2, ab, 3], None: [2, c, c, 3]}


def test_long_merge_lists_encode_the_same(spark, sf001, monkeypatch):
    vocab, merges = bpe.bpe_train(catalog.train_words(spark, sf001), num_merges=60)
    s = catalog.split_docs(spark, sf001).filter("doc_id < 20")
    more = spark.createDataFrame([(-1, 0, "a\uffffb \uffff \u4e00\U0001f600"), (-2, 0, "")], "doc_id long, pos long, story string")
    s = s.select("doc_id", "pos", "story").union(more)
    want = sorted(bpe.bpe_encode(s, vocab, merges, ["doc_id", "pos"]).collect())
    monkeypatch.setattr(bpe, "merge_passes", lambda merges: None)
    assert sorted(bpe.bpe_encode(s, vocab, merges, ["doc_id", "pos"]).collect()) == want


def test_a_filter_on_ids_does_not_encode_again(spark):
    vocab, merges = bpe.bpe_train(spark.createDataFrame([("ab", 5)], "word string, freq long"), vocab_size=7)
    df = spark.createDataFrame([(1, "ab c"), (2, "ab")], "k long, story string")
    known = bpe.bpe_encode(df, vocab, merges, ["k"]).filter(~F.array_contains("ids", tok.UNK_ID))
    plan = known._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1 and [r.k for r in known.collect()] == [2]


def test_training_leaves_no_tables(spark, sf001):
    """The state of every round stayed in the shared folder."""
    import os

    from talewright.session import ensure_checkpoint_dir
    top = os.path.join(ensure_checkpoint_dir(spark), "landed").removeprefix("file:")
    words = catalog.train_words(spark, sf001)
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    bpe.bpe_train(words, num_merges=40)
    assert set(os.listdir(top)) == before
