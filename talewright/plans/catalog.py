"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
built from the given tables. Keys match SURVEY §2 and the DuckDB twins in
:mod:`talewright.plans.oracle`."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import coalesce_key, ids_to_string
from ..operators import blocks, bpe, metrics, ngram, ordering, packing, sampling, scores, sweeps
from ..operators import tokenizer as tok
from ..operators.sparse_scores import SparseScores
from ..operators.tokenizer import chars_of
from ..session import ensure_checkpoint_dir, land_table
from ..sources import logs as logsrc
from ..sources import records, stories
from ..streaming import incremental as inc
from .inputs import doc_bucket, doc_split, input_stamp, instruct_lines, landed, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- blocks


def _blocked(spark, sf_dir):
    from .inputs import doc_bucket
    return blocks.assign_blocks(instruct_lines(spark, sf_dir), "src", ["doc_id", "k"], doc_bucket())


@query("block_ids")
def q_block_ids(spark, sf_dir):
    return _blocked(spark, sf_dir).select("doc_id", "k", "block")


@query("classify_lines")
def q_classify_lines(spark, sf_dir):
    return blocks.classify_lines(_blocked(spark, sf_dir)).select("doc_id", "k", "ctype", "cval")


@query("in_story_flag")
def q_in_story_flag(spark, sf_dir):
    c = blocks.classify_lines(_blocked(spark, sf_dir))
    return blocks.story_lines(c, ["src", "block"], "ord").select("doc_id", "k", "in_story")


@query("assemble_records")
def q_assemble_records(spark, sf_dir):
    recs = blocks.assemble_records(_blocked(spark, sf_dir), ["src", "block"], "ord")
    return recs.select("block", "prompt", "response")


@query("build_prompt")
def q_build_prompt(spark, sf_dir):
    c = blocks.classify_lines(_blocked(spark, sf_dir).filter(F.col("line") != ""))
    cons = c.filter(F.col("ctype").isin("features", "words", "summary"))
    per_block = c.select("src", "block").distinct().join(
        cons.groupBy("src", "block").agg(
            F.array_sort(F.collect_list(F.struct("ord", "ctype", "cval"))).alias("cs")
        ),
        on=["src", "block"], how="left",
    )
    cs = F.coalesce(F.col("cs"), F.array().cast("array<struct<ord:struct<doc_id:bigint,k:bigint>,ctype:string,cval:string>>"))
    return per_block.select("block", blocks.build_prompt(cs).alias("prompt"))


@query("chat_pairs")
def q_chat_pairs(spark, sf_dir):
    return blocks.chat_pairs(read(spark, sf_dir, "conversations"))


@query("full_text")
def q_full_text(spark, sf_dir):
    return blocks.full_text(q_chat_pairs(spark, sf_dir)).select("conv_id", "turn", "prompt_text", "full_text")


@query("valid_records")
def q_valid_records(spark, sf_dir):
    return blocks.record_counts(q_chat_pairs(spark, sf_dir))


# ---------------------------------------------------------------- sources, order, projections


BYTE_BUDGET = 65536     # bytes read per source
CAP_PER_SOURCE = 20     # stories kept per source
FILL_TRAIN, FILL_VAL = 600, 200
SAMPLE_N, SAMPLE_SEED = 100, 1337


def _json_docs(spark, sf_dir):
    """JSON of four shapes built from ``documents`` (by language)."""
    docs = read(spark, sf_dir, "documents")
    t = F.col("text")
    js = (
        F.when(F.col("lang") == "en", F.to_json(F.struct(t.alias("text"))))
        .when(F.col("lang") == "fr", F.to_json(F.struct(t.alias("story"), F.lit(1).alias("other"))))
        .when(F.col("lang") == "de", F.to_json(F.split(t, "\n")))
        .otherwise(F.to_json(F.array(
            F.struct(F.lit("").alias("text"), t.alias("story")),
            F.struct(F.lit(None).cast("string").alias("text"), t.alias("story")),
        )))
    )
    return docs.select("doc_id", js.alias("json"))


@query("split_stories")
def q_split_stories(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return stories.split_stories(docs, "text", sep="\n")


@query("json_stories")
def q_json_stories(spark, sf_dir):
    return stories.json_stories(_json_docs(spark, sf_dir), "json")


def file_name(key: str):
    """A file name by hashed id, as an archive of stories has them: some of
    train, some of val, some of both words (train wins), some of neither."""
    kind = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 1), 16, 10).cast("int")
    return F.concat(F.when(kind < 6, F.lit("Stories-TRAIN-")).when(kind < 10, F.lit("stories_valid_"))
                    .when(kind < 12, F.lit("val-of-train-")).otherwise(F.lit("readme-")), F.col(key).cast("string"), F.lit(".txt"))


@query("format_fallback")
def q_format_fallback(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    # the text files of val alone leave the train side to the JSON files
    named = docs.select("doc_id", "text", stories.route_split(file_name("doc_id")).alias("split"))
    primary = stories.split_stories(named.filter(F.col("split") == "val"), "text", sep="\n").select("split", "doc_id", F.col("pos").alias("item_pos"), "story")
    secondary = stories.json_stories(_json_docs(spark, sf_dir), "json").select(
        doc_split().alias("split"), "doc_id", "item_pos", "story"
    )
    return stories.read_with_fallback(primary, secondary)


@query("route_split")
def q_route_split(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return pages.select("page_id", stories.route_split(file_name("page_id")).alias("split")).filter(F.col("split").isNotNull())


@query("byte_budget")
def q_byte_budget(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("source", "doc_id", "text")
    return ordering.byte_budget(docs, "source", ["doc_id"], doc_bucket(), BYTE_BUDGET).select("source", "doc_id", "text")


@query("per_source_cap")
def q_per_source_cap(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("source", "doc_id")
    return ordering.per_source_cap(docs, "source", ["doc_id"], CAP_PER_SOURCE).withColumn("rank", F.col("rank").cast("bigint"))


@query("fill_order_split")
def q_fill_order_split(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id")
    return ordering.fill_order_split(docs, ["doc_id"], doc_bucket(), FILL_TRAIN, FILL_VAL)


@query("ordered_index")
def q_ordered_index(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang")
    return ordering.ordered_index(docs, ["lang", "doc_id"], F.struct("lang", doc_bucket())).select("doc_id", "lang", "idx")


@query("strip_nonempty")
def q_strip_nonempty(spark, sf_dir):
    conv = read(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return stories.split_stories(conv, "text", sep="\n", out="line")


@query("default_key")
def q_default_key(spark, sf_dir):
    ev = read(spark, sf_dir, "events").select("event_id", "props")
    return ev.select(
        "event_id",
        coalesce_key(F.get_json_object("props", "$.k")).alias("k"),
        coalesce_key(F.get_json_object("props", "$.text")).alias("text"),
    )


@query("min_length")
def q_min_length(spark, sf_dir):
    from ..operators.blocks import filter_min_length
    return filter_min_length(q_split_stories(spark, sf_dir), "story", 40)


@query("sample_n")
def q_sample_n(spark, sf_dir):
    pairs = q_chat_pairs(spark, sf_dir).select("conv_id", "turn")
    return sampling.sample_n(pairs, ["conv_id", "turn"], SAMPLE_N, SAMPLE_SEED)


@query("ratio_split")
def q_ratio_split(spark, sf_dir):
    recs = q_assemble_records(spark, sf_dir).select("block")
    return ordering.ratio_split(recs, ["block"], ordering.bucket_of("block", 1024), 0.90, 0.05, 0.05)


@query("round_robin")
def q_round_robin(spark, sf_dir):
    docs = ordering.ordered_index(read(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], doc_bucket(), out="i")
    prompts = ordering.ordered_index(
        read(spark, sf_dir, "benchmark").select("item_id"), ["item_id"], ordering.bucket_of("item_id", 1024), out="p"
    )
    return sampling.round_robin(docs, "i", prompts, "p").select("doc_id", "item_id")


# ---------------------------------------------------------------- tokenizers


BPE_VOCAB = 256         # vocabulary size of the SQL-checked tokenizer (the smallest published size)
_TOKENIZERS: dict = {}


def split_docs(spark, sf_dir):
    """Stories = lines of ``documents`` (stripped, non-empty), with the hashed
    train/val split of their document. Order key (doc_id, pos)."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", doc_split().alias("split"))
    return stories.split_stories(docs, "text", sep="\n")


def train_words(spark, sf_dir):
    """Pre-token counts of the train text (stories joined by a blank line:
    each separator adds two "\\n" pre-tokens)."""
    train = split_docs(spark, sf_dir).filter(F.col("split") == "train")
    sep = train.agg((F.lit(2) * (F.count(F.lit(1)) - 1)).cast("bigint").alias("freq")).select(
        F.lit("\n").alias("word"), "freq").filter(F.col("freq") > 0)
    return tok.word_counts(tok.pretokenize(train, "story"), "words", extra=sep)


def bpe_tokenizer(spark, sf_dir, vocab_size=BPE_VOCAB):
    key = (spark.sparkContext.applicationId, sf_dir, input_stamp(spark, sf_dir), vocab_size)
    if key not in _TOKENIZERS:
        words = landed(spark, sf_dir, "train_words", lambda: train_words(spark, sf_dir))
        _TOKENIZERS[key] = bpe.bpe_train(words, vocab_size=vocab_size, min_frequency=2)
    return _TOKENIZERS[key]


def char_tokenizer(spark, sf_dir):
    """Char vocabulary of the train text (bounded by the code-point range),
    landed once per session."""
    def build():
        train = split_docs(spark, sf_dir).filter(F.col("split") == "train")
        return tok.char_vocab(train, "story")
    return landed(spark, sf_dir, "char_vocab", build)


@query("char_vocab")
def q_char_vocab(spark, sf_dir):
    return char_tokenizer(spark, sf_dir)


@query("char_encode")
def q_char_encode(spark, sf_dir):
    enc = tok.char_encode(split_docs(spark, sf_dir), char_tokenizer(spark, sf_dir), "story", on_oov="flag")
    return enc.select("doc_id", "pos", ids_to_string("ids").alias("ids"), "n_oov")


@query("char_decode")
def q_char_decode(spark, sf_dir):
    vocab = char_tokenizer(spark, sf_dir)
    enc = tok.char_encode(split_docs(spark, sf_dir), vocab, "story", on_oov="unk")
    return tok.char_decode(enc, vocab, "ids").select("doc_id", "pos", "text")


@query("pretokenize")
def q_pretokenize(spark, sf_dir):
    s = tok.pretokenize(split_docs(spark, sf_dir), "story")
    return s.select("doc_id", "pos", F.posexplode("words").alias("tpos", "word")).withColumn(
        "tpos", F.col("tpos").cast("bigint"))


@query("word_counts")
def q_word_counts(spark, sf_dir):
    return train_words(spark, sf_dir)


@query("byte_symbols")
def q_byte_symbols(spark, sf_dir):
    return train_words(spark, sf_dir).select("word", tok.byte_symbols("word").alias("seg"))


@query("pair_counts")
def q_pair_counts(spark, sf_dir):
    w = train_words(spark, sf_dir).select(tok.byte_symbols("word").alias("seg"), "freq")
    return tok.pair_counts(w)


@query("bpe_train")
def q_bpe_train(spark, sf_dir):
    return bpe_tokenizer(spark, sf_dir)[1].withColumn("rank", F.col("rank").cast("bigint"))


@query("special_tokens")
def q_special_tokens(spark, sf_dir):
    return bpe_tokenizer(spark, sf_dir)[0].withColumn("id", F.col("id").cast("bigint"))


def bpe_encoded(spark, sf_dir, split=None):
    vocab, merges = bpe_tokenizer(spark, sf_dir)
    s = split_docs(spark, sf_dir)
    if split:
        s = s.filter(F.col("split") == split)
    return bpe.bpe_encode(s, vocab, merges, ["doc_id", "pos"], "story")


@query("bpe_encode")
def q_bpe_encode(spark, sf_dir):
    return bpe_encoded(spark, sf_dir).select("doc_id", "pos", ids_to_string("ids").alias("ids"))


@query("token_stats")
def q_token_stats(spark, sf_dir):
    s = split_docs(spark, sf_dir)
    # a character is a token of the char level: its texts need no arrays
    chars = s.select(F.lit("char").alias("tokenizer"), F.length("story").alias("n"))
    pieces = bpe_encoded(spark, sf_dir).select(F.lit("bpe").alias("tokenizer"), F.size("ids").alias("n"))
    st = tok.token_stats(chars.unionByName(pieces), n_col="n")
    return st.withColumn("avg_tokens", F.round("avg_tokens", 6))


# ---------------------------------------------------------------- streams, SFT samples, n-gram model, metrics


BLOCK = 4096            # tokens per stream block
ALPHA = 1.0             # add-alpha smoothing of the count model
SFT_CONTEXT = 256       # SFT context length (tokens)
# benchmark sweep: comma lists as given on a command line, and the defaults
SWEEP = {"seeds": "1337, 42,,7", "d_models": "", "contexts": ""}
RUN_DEFAULTS = {"d_model": 96, "context_length": 128, "batch_size": 32, "eval_iters": 200}
PROMPT_TEMPERATURE, PROMPT_TOP_K, PROMPT_PENALTY, PROMPT_SEED = 0.8, 20, 1.3, 1337


def char_stream(spark, sf_dir):
    """Char-level token stream blocks per split, separator "\\n\\n";
    landed once per session (the tokenized corpus is an artifact)."""
    def build():
        # every character is one token, so the text is packed and its blocks are
        # encoded: nothing is cached, and ids are not shuffled
        text = packing.pack_stream(split_docs(spark, sf_dir), ["doc_id", "pos"], doc_bucket(), "\n\n", BLOCK, ids_col="story")
        # the write by split needs that order: the text is sorted, not its ids
        text = text.sortWithinPartitions("split")
        enc = tok.char_encode(text, char_tokenizer(spark, sf_dir), "story", on_oov="unk")
        return land_table(enc.select("split", "block_id", "ids"), "split")
    return landed(spark, sf_dir, "char_stream", build, cut=False)


def char_pairs(spark, sf_dir):
    return packing.next_token_pairs(char_stream(spark, sf_dir), block_size=BLOCK)


def char_vocab_size(spark, sf_dir):
    """The characters of the train text and one id for all others."""
    return char_tokenizer(spark, sf_dir).count() + 1


def char_model(spark, sf_dir):
    def build():
        pairs = char_pairs(spark, sf_dir).filter(F.col("split") == "train")
        return ngram.ngram_fit(pairs, char_vocab_size(spark, sf_dir), ALPHA)
    return landed(spark, sf_dir, "char_model", build)


def char_scores(spark, sf_dir):
    """The count model's log-probabilities: seen pairs and one floor per context."""
    return SparseScores.of_counts(char_model(spark, sf_dir), char_vocab_size(spark, sf_dir), ALPHA)


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


@query("pack_stream")
def q_pack_stream(spark, sf_dir):
    b = char_stream(spark, sf_dir)
    return b.select("split", "block_id", F.size("ids").cast("bigint").alias("n_tokens"), ids_to_string("ids").alias("ids"))


@query("next_token_pairs")
def q_next_token_pairs(spark, sf_dir):
    return char_pairs(spark, sf_dir)


@query("ngram_fit")
def q_ngram_fit(spark, sf_dir):
    m = char_model(spark, sf_dir)
    return m.select("token", "next_token", F.col("count").cast("bigint").alias("count"), r6("logprob").alias("logprob"))


@query("ngram_score")
def q_ngram_score(spark, sf_dir):
    pairs = char_pairs(spark, sf_dir).filter(F.col("split") == "val")
    s = ngram.ngram_score(pairs, char_model(spark, sf_dir), char_vocab_size(spark, sf_dir), ALPHA)
    return s.select("token", "next_token", F.col("n").cast("bigint").alias("n"), r6("nll").alias("nll"), "correct")


@query("ngram_eval")
def q_ngram_eval(spark, sf_dir):
    pairs = char_pairs(spark, sf_dir)
    V = char_vocab_size(spark, sf_dir)
    rep = ngram.score_report(ngram.ngram_score(pairs, char_model(spark, sf_dir), V, ALPHA, by=["split"]), ["split"])
    return rep.select("split", "n_tokens", *[r6(c).alias(c) for c in ("loss", "perplexity", "bpc", "top1_accuracy")])


def bpe_stream(spark, sf_dir):
    """BPE token stream blocks per split: one ``[BOS]``, the stories with two
    newline tokens between, one ``[EOS]``; landed once per session."""
    def build():
        # every token is one character of the coded text, so that is what is packed
        encoder = bpe.Encoder(*bpe_tokenizer(spark, sf_dir))
        coder = bpe.TextCoder(encoder)
        code = bpe.bpe_code(split_docs(spark, sf_dir), encoder, coder, ["doc_id", "pos", "split"], "story")
        blocks = packing.pack_stream(land_table(code), ["doc_id", "pos"], doc_bucket(), "\n\n", BLOCK, ids_col="code",
                                     bos_eos=True, ends=coder.ends)
        return blocks.select("split", "block_id", coder.ids("code").alias("ids"))
    return landed(spark, sf_dir, "bpe_stream", build)


@query("pack_bpe_stream")
def q_pack_bpe_stream(spark, sf_dir):
    b = bpe_stream(spark, sf_dir)
    return b.select("split", "block_id", F.size("ids").cast("bigint").alias("n_tokens"), ids_to_string("ids").alias("ids"))


@query("bpe_stream_eval")
def q_bpe_stream_eval(spark, sf_dir):
    """Fit on the train stream of BPE ids, score every position of both streams."""
    pairs = packing.next_token_pairs(bpe_stream(spark, sf_dir), block_size=BLOCK)
    V = bpe_tokenizer(spark, sf_dir)[0].count()
    rep = ngram.ngram_eval(pairs.filter(F.col("split") == "train"), pairs, V, ALPHA)
    return rep.select("split", "n_tokens", *[r6(c).alias(c) for c in ("loss", "perplexity", "bpc", "top1_accuracy")])


# -- window-sampled evaluation over a seed sweep (the benchmark suite)


def sweep_runs(spark):
    grid = sweeps.sweep_grid(spark, SWEEP["seeds"], SWEEP["d_models"], SWEEP["contexts"])
    return sweeps.apply_overrides(grid, RUN_DEFAULTS)


def eval_windows(spark, sf_dir, runs=None):
    runs = runs if runs is not None else sweep_runs(spark)
    blocks = char_stream(spark, sf_dir)
    sizes = blocks.groupBy("split").agg(F.sum(F.size("ids")).cast("bigint").alias("n_tokens"))
    draws = packing.draw_table(spark, runs.select("seed", "context_length", "batch_size", "eval_iters"), ["train", "val"])
    return packing.window_batch(blocks, draws, sizes, BLOCK)


def eval_positions(spark, sf_dir):
    """Every (x_i, y_i) of every window, scored by the count model; landed once
    for all reports of the sweep."""
    train, val = (timed_eval(spark, sf_dir)[split][0] for split in ("train", "val"))
    return train.unionByName(val)


def timed_eval(spark, sf_dir):
    """{split: (scored positions, tokens, seconds)}: the evaluation of each split
    is one job, which counts its tokens and is timed as it lands its rows."""
    def build():
        out = {}
        for split in ("train", "val"):
            counted = Observation()
            began = time.perf_counter()
            rows = land_table(_eval_positions(spark, sf_dir, split).observe(counted, F.count(F.lit(1)).alias("tokens")))
            out[split] = rows, int(counted.get["tokens"]), time.perf_counter() - began
        return out
    return landed(spark, sf_dir, "timed_eval", build, cut=False)


def eval_speed(spark, sf_dir):
    """AGG9 over the measured evaluation: (split, tokens, seconds, tokens_per_sec)."""
    rows = [(split, tokens, seconds) for split, (_, tokens, seconds) in timed_eval(spark, sf_dir).items()]
    return metrics.throughput(spark.createDataFrame(rows, "split string, tokens bigint, seconds double"), ["split"])


@query("eval_throughput")
def q_eval_throughput(spark, sf_dir):
    """Tokens that the timed evaluation scored; the time itself is only known
    to be above zero."""
    d = eval_speed(spark, sf_dir)
    return d.select("split", "tokens", ((F.col("seconds") > 0) & (F.col("tokens_per_sec") > 0)).alias("timed"))


def _eval_positions(spark, sf_dir, split):
    w = eval_windows(spark, sf_dir).filter(F.col("split") == split)
    z = w.select("seed", "split", "batch", "draw", F.posexplode(F.arrays_zip(F.col("x").alias("token"), F.col("y").alias("next_token"))).alias("i", "p"))
    pairs = z.select("seed", "split", "batch", "draw", "i", "p.token", "p.next_token")
    model = char_model(spark, sf_dir)
    V = char_vocab_size(spark, sf_dir)
    pc = model.select("token", "next_token", "count")
    ctx = ngram.context_table(model)
    d = pairs.join(pc, ["token", "next_token"], "left").join(ctx, "token", "left")
    nll = -F.log((F.coalesce("count", F.lit(0)) + F.lit(ALPHA)) / (F.coalesce("ctx_total", F.lit(0)) + F.lit(ALPHA * V)))
    return d.select("seed", "split", "batch", "draw", "i", "token", "next_token", nll.alias("nll"),
                    (F.coalesce("pred", F.lit(0)) == F.col("next_token")).cast("int").alias("correct"))


def eval_report_df(spark, sf_dir):
    pos = eval_positions(spark, sf_dir)
    mb = metrics.mean_of_batches(pos, ["seed", "split"], "batch", "nll")
    acc = pos.groupBy("seed", "split").agg(F.avg("correct").alias("top1_accuracy"), F.count(F.lit(1)).cast("bigint").alias("n_tokens"))
    return metrics.loss_metrics(mb.join(acc, ["seed", "split"]))


@query("window_batch")
def q_window_batch(spark, sf_dir):
    w = eval_windows(spark, sf_dir)
    return w.select("seed", "split", F.col("batch").cast("bigint").alias("batch"), "draw", "start", ids_to_string("x").alias("x"), ids_to_string("y").alias("y"))


@query("token_nll")
def q_token_nll(spark, sf_dir):
    """Loss of every position of every window, summed up per window."""
    pos = eval_positions(spark, sf_dir)
    targets = pos.select("seed", "split", "draw", F.col("token").alias("ctx_id"), F.col("next_token").alias("target"))
    out = char_scores(spark, sf_dir).token_nll(targets)
    return out.groupBy("seed", "split", "draw").agg(
        F.count("nll").alias("n_tokens"), r6(F.sum("nll")).alias("nll_sum"), r6(F.min("nll")).alias("nll_min"), r6(F.max("nll")).alias("nll_max"))


@query("mean_batch_loss")
def q_mean_batch_loss(spark, sf_dir):
    mb = metrics.mean_of_batches(eval_positions(spark, sf_dir), ["seed", "split"], "batch", "nll")
    return mb.select("seed", "split", F.col("n_batches").cast("bigint").alias("n_batches"), r6("loss").alias("loss"))


@query("loss_metrics")
def q_loss_metrics(spark, sf_dir):
    mb = metrics.mean_of_batches(eval_positions(spark, sf_dir), ["seed", "split"], "batch", "nll")
    lm = metrics.loss_metrics(mb)
    return lm.select("seed", "split", *[r6(c).alias(c) for c in ("loss", "perplexity", "bpc")])


@query("top1_accuracy")
def q_top1_accuracy(spark, sf_dir):
    pos = eval_positions(spark, sf_dir)
    targets = pos.select("seed", "split", F.col("token").alias("ctx_id"), F.col("next_token").alias("target"))
    acc = metrics.top1_accuracy(char_scores(spark, sf_dir).argmax(), targets, ["seed", "split"])
    return acc.select("seed", "split", F.col("total").cast("bigint").alias("total"), r6("top1_accuracy").alias("top1_accuracy"))


@query("eval_report")
def q_eval_report(spark, sf_dir):
    rep = eval_report_df(spark, sf_dir)
    return rep.select("seed", "split", F.col("n_batches").cast("bigint").alias("n_batches"), "n_tokens",
                      *[r6(c).alias(c) for c in ("loss", "perplexity", "bpc", "top1_accuracy")])


@query("seed_stability")
def q_seed_stability(spark, sf_dir):
    val = eval_report_df(spark, sf_dir).filter(F.col("split") == "val").select(
        F.col("loss").alias("val_loss"), F.col("perplexity").alias("val_perplexity"))
    st = metrics.seed_stability(val)
    return st.select(F.col("num_runs").cast("bigint").alias("num_runs"),
                     *[r6(c).alias(c) for c in ("val_loss_mean", "val_loss_std", "val_ppl_mean", "val_ppl_std")])


@query("sweep_grid")
def q_sweep_grid(spark, sf_dir):
    grid = sweeps.sweep_grid(spark, SWEEP["seeds"], SWEEP["d_models"], SWEEP["contexts"])
    val = eval_report_df(spark, sf_dir).filter(F.col("split") == "val").select("seed", F.col("loss").alias("val_loss"))
    return grid.join(val, "seed", "left").select("seed", "d_model", "context_length", r6("val_loss").alias("val_loss"))


@query("config_override")
def q_config_override(spark, sf_dir):
    runs = sweep_runs(spark)
    windows = eval_windows(spark, sf_dir).groupBy("seed").agg(F.count(F.lit(1)).cast("bigint").alias("windows"))
    return runs.join(windows, "seed", "left").select(
        "seed", *[F.col(c).cast("bigint").alias(c) for c in RUN_DEFAULTS], "windows")


@query("bits_per_char")
def q_bits_per_char(spark, sf_dir):
    pairs = char_pairs(spark, sf_dir)
    V = char_vocab_size(spark, sf_dir)
    sc = ngram.ngram_score(pairs, char_model(spark, sf_dir), V, ALPHA, by=["split"])
    chars = char_tokenizer(spark, sf_dir).select(F.col("id").alias("next_token"), F.length("token").alias("_len"))
    d = sc.join(chars, "next_token", "left").select(
        "split", (F.col("n") * F.col("nll")).alias("nll"), (F.col("n") * F.coalesce("_len", F.lit(1))).alias("chars"))
    return metrics.bits_per_char(d, ["split"]).select("split", r6("bits_per_char").alias("bits_per_char"), "chars")


@query("throughput")
def q_throughput(spark, sf_dir):
    ev = read(spark, sf_dir, "events")
    per = ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("tokens"),
        (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))).alias("_us"))
    per = per.withColumn("seconds", F.col("_us") / F.lit(1e6))
    return metrics.throughput(per, ["event_type"]).select(
        "event_type", "tokens", r6("seconds").alias("seconds"), r6("tokens_per_sec").alias("tokens_per_sec"))


# -- log windows (events as a training log: run = event_type, step = event_id, loss = value)

LOG_BUCKET = 4096


def train_log(spark, sf_dir):
    ev = read(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("val_loss"), "ts")


@query("best_so_far")
def q_best_so_far(spark, sf_dir):
    d = metrics.best_so_far(train_log(spark, sf_dir), "run", "step", "val_loss", ordering.bucket_of("step", LOG_BUCKET))
    return d.select("run", "step", "val_loss", "best_before", "is_best")


@query("eval_points")
def q_eval_points(spark, sf_dir):
    return metrics.eval_points(train_log(spark, sf_dir), "run", "step", 500).select("run", "step")


def daily_runs(spark, sf_dir):
    log = train_log(spark, sf_dir)
    return log.groupBy("run", F.to_date("ts").alias("day")).agg(F.avg("val_loss").alias("val_loss"), F.count(F.lit(1)).alias("steps"))


@query("run_delta")
def q_run_delta(spark, sf_dir):
    d = metrics.run_delta(daily_runs(spark, sf_dir), "run", "day", ["val_loss"])
    return d.select("run", F.col("day").cast("string").alias("day"), r6("val_loss").alias("val_loss"), r6("val_loss_delta").alias("val_loss_delta"))


@query("compare_runs")
def q_compare_runs(spark, sf_dir):
    d = daily_runs(spark, sf_dir).withColumn("val_loss", F.round("val_loss", 6))
    c = metrics.compare_runs(d, "day", "run", "val_loss")
    return c.select(F.col("day").cast("string").alias("day"), "run", "val_loss", F.col("rank").cast("bigint").alias("rank"), "winner")


@query("best_checkpoint")
def q_best_checkpoint(spark, sf_dir):
    return metrics.pick_best(train_log(spark, sf_dir), "run", "step", "val_loss")


# -- prompts as contexts: repetition penalty, top-k, one draw


def prompt_contexts(spark, sf_dir):
    """Benchmark items as generation prompts: char ids, last id = context token."""
    items = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("ctx_id"), F.col("text").alias("story"))
    enc = tok.char_encode(items, char_tokenizer(spark, sf_dir), "story", on_oov="unk").filter(
        F.size("ids") > 0)
    return enc.select("ctx_id", "ids", F.element_at("ids", -1).alias("last"))


def prompt_scores(spark, sf_dir):
    """All scores after each prompt, a row per prompt and token."""
    ctx = prompt_contexts(spark, sf_dir).select(F.col("ctx_id").alias("prompt"), "last")
    return char_scores(spark, sf_dir).of_contexts(ctx, "prompt", "last").withColumnRenamed("prompt", "ctx_id")


def prompt_history(spark, sf_dir):
    return prompt_contexts(spark, sf_dir).select("ctx_id", F.explode("ids").alias("token_id"))


@query("seen_penalty")
def q_seen_penalty(spark, sf_dir):
    d = scores.repetition_penalty(prompt_scores(spark, sf_dir), prompt_history(spark, sf_dir), PROMPT_PENALTY)
    return d.select("ctx_id", "token_id", r6("logit").alias("logit"))


@query("top_k_filter")
def q_top_k_filter(spark, sf_dir):
    """The k-th score comes from the sparse table; the rows are only marked."""
    ctx = prompt_contexts(spark, sf_dir).select("ctx_id", F.col("last"))
    cuts = ctx.join(char_scores(spark, sf_dir).cuts(5).withColumnRenamed("ctx_id", "last"), "last").select("ctx_id", "cut")
    d = prompt_scores(spark, sf_dir).join(cuts, "ctx_id")
    return d.select("ctx_id", "token_id", r6("logit").alias("logit"), (F.col("logit") >= F.col("cut")).alias("kept"))


@query("sample_next")
def q_sample_next(spark, sf_dir):
    return scores.sample_next(prompt_scores(spark, sf_dir), prompt_history(spark, sf_dir),
                              PROMPT_TEMPERATURE, PROMPT_TOP_K, PROMPT_PENALTY, PROMPT_SEED)


@query("oov_tokens")
def q_oov_tokens(spark, sf_dir):
    """Characters of the val text that the alphabet of the English train text
    does not have."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", doc_split().alias("split"))
    d = stories.split_stories(docs, "text", sep="\n")
    alphabet = tok.char_vocab(d.filter((F.col("split") == "train") & (F.col("lang") == "en")), "story").select("token")
    # counted per character first: one row per distinct character is joined
    val = d.filter(F.col("split") == "val")
    chars = val.select(F.explode(chars_of("story")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return chars.join(alphabet, "token", "left_anti")


# -- corpus profile


@query("corpus_profile")
def q_corpus_profile(spark, sf_dir):
    return metrics.corpus_profile(instruct_lines(spark, sf_dir), q_assemble_records(spark, sf_dir))


@query("prompt_diversity")
def q_prompt_diversity(spark, sf_dir):
    return metrics.prompt_diversity(q_assemble_records(spark, sf_dir))


# -- SFT samples (chat pairs, byte-level BPE with BOS/EOS on every encode)


def sft_records(spark, sf_dir):
    pairs = q_chat_pairs(spark, sf_dir)
    return ordering.ratio_split(pairs, ["conv_id", "turn"], ordering.bucket_of("conv_id", 1024), 0.90, 0.05, 0.05)


def _encode_sft(spark, sf_dir):
    vocab, merges = bpe_tokenizer(spark, sf_dir)
    recs = blocks.full_text(sft_records(spark, sf_dir))
    keys = ["conv_id", "turn", "split"]
    # full text and prompt as two rows: their words are encoded in one pass
    texts = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_text").alias("text")) for k in ("full", "prompt")])
    both = recs.select(*keys, F.inline(texts))
    enc = bpe.bpe_encode(both, vocab, merges, [*keys, "kind"], "text")
    ids = lambda k: F.first(F.when(F.col("kind") == k, F.col("ids")), ignorenulls=True).alias(f"{k}_ids")
    return enc.groupBy(*keys).agg(ids("full"), ids("prompt"))


def sft_encoded(spark, sf_dir):
    """BPE-encoded chat records (full text and prompt text), landed once."""
    return landed(spark, sf_dir, "sft_encoded", lambda: _encode_sft(spark, sf_dir))


def sft_trip(spark, sf_dir):
    return packing.sft_triplets(sft_encoded(spark, sf_dir), SFT_CONTEXT)


def _mask_str(c):
    return ids_to_string(F.transform(c, lambda x: x.cast("int")))


@query("sft_triplets")
def q_sft_triplets(spark, sf_dir):
    t = sft_trip(spark, sf_dir)
    return t.select("conv_id", "turn", "split", F.size("full_ids").cast("bigint").alias("full_len"),
                    F.size("prompt_ids").cast("bigint").alias("prompt_len"),
                    ids_to_string("tokens").alias("tokens"), ids_to_string("targets").alias("targets"),
                    _mask_str("mask").alias("mask"))


@query("special_pair")
def q_special_pair(spark, sf_dir):
    """TOK9, pair template: prompt and full text as one sample."""
    inner = lambda c: F.slice(c, 2, F.size(c) - 2)  # noqa: E731  (without their own [BOS] and [EOS])
    e = sft_encoded(spark, sf_dir)
    return e.select("conv_id", "turn", ids_to_string(tok.add_specials_pair(inner("prompt_ids"), inner("full_ids"))).alias("ids"))


@query("truncate_pad")
def q_truncate_pad(spark, sf_dir):
    e = sft_encoded(spark, sf_dir)
    return e.select("conv_id", "turn", ids_to_string(packing.truncate_pad("full_ids", SFT_CONTEXT)).alias("tokens"))


@query("shift_targets")
def q_shift_targets(spark, sf_dir):
    e = sft_encoded(spark, sf_dir)
    return e.select("conv_id", "turn", ids_to_string(packing.shift_targets("full_ids", SFT_CONTEXT)).alias("targets"))


@query("loss_mask")
def q_loss_mask(spark, sf_dir):
    e = sft_encoded(spark, sf_dir)
    m = packing.loss_mask(F.size("full_ids"), F.size("prompt_ids"), SFT_CONTEXT, compat=True)
    return e.select("conv_id", "turn", _mask_str(m).alias("mask"))


@query("mask_coverage")
def q_mask_coverage(spark, sf_dir):
    c = packing.mask_coverage(sft_trip(spark, sf_dir), SFT_CONTEXT)
    return c.select(*[F.col(x).cast("bigint").alias(x) for x in c.columns])


@query("masked_loss")
def q_masked_loss(spark, sf_dir):
    """Per record ``sum(nll * mask) / max(sum(mask), 1)``; the nll of each
    position comes from a count model fit on the train records' real
    (token, target) pairs, smoothed over the BPE vocabulary."""
    t = sft_trip(spark, sf_dir)
    V = bpe_tokenizer(spark, sf_dir)[0].count()
    L = F.least(F.size("full_ids"), F.lit(SFT_CONTEXT))
    pos = t.select("conv_id", "turn", "split", L.alias("L"),
                   F.posexplode(F.arrays_zip(F.col("tokens").alias("token"), F.col("targets").alias("next_token"),
                                             F.col("mask").alias("m"))).alias("i", "p"))
    pos = pos.select("conv_id", "turn", "split", "L", "i", "p.token", "p.next_token", "p.m")
    train_pairs = pos.filter((F.col("split") == "train") & (F.col("i") < F.col("L") - 1))
    model = ngram.ngram_fit(train_pairs, V, ALPHA)
    scored = ngram.ngram_score(pos.filter(F.col("m") > 0), model, V, ALPHA, by=["conv_id", "turn"])
    per = scored.groupBy("conv_id", "turn").agg(F.sum(F.col("n") * F.col("nll")).alias("_num"), F.sum("n").alias("_den"))
    recs = t.select("conv_id", "turn")
    out = recs.join(per, ["conv_id", "turn"], "left")
    ml = F.coalesce(F.col("_num"), F.lit(0.0)) / F.greatest(F.coalesce(F.col("_den"), F.lit(0)).cast("double"), F.lit(1.0))
    return out.select("conv_id", "turn", r6(ml).alias("masked_loss"))


@query("record_batch")
def q_record_batch(spark, sf_dir):
    recs = sft_records(spark, sf_dir)
    idx = ordering.ordered_index(recs, ["conv_id", "turn"], ordering.bucket_of("conv_id", 1024), ["split"])
    b = sampling.record_batch(idx, "train", 16, 1337)
    return b.select("draw", "conv_id", "turn")


# -- file round trips: SFT JSON Lines, benchmark summary log, generated samples


def _landing_dir(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), "landed", f"{name}-{uuid.uuid4().hex}")


@query("sft_records")
def q_sft_records(spark, sf_dir):
    """SNK2 then SRC8: write the split chat records as JSON Lines (empty
    prompt/response skipped), read them back with a fixed schema."""
    out = _landing_dir(spark, "sft")
    records.write_sft(sft_records(spark, sf_dir), out)
    back = records.read_sft(spark, out)
    return back.select("split", "prompt", "response")


def sweep_seeds():
    return [int(x) for x in SWEEP["seeds"].split(",") if x.strip()]


SAMPLE_COUNT = 3   # generated samples per run; sample i uses prompt i % len(prompts)


def run_samples(spark, sf_dir):
    """Per run (seed): ``SAMPLE_COUNT`` samples, sample ``i`` on prompt
    ``i % len(prompts)`` (round robin over ``benchmark`` in item order); a
    sample is the prompt plus one drawn next character. Parameter-sized."""
    vocab = char_tokenizer(spark, sf_dir).select(F.col("id").alias("token_id"), F.col("token").alias("next_char"))
    prompts = ordering.ordered_index(
        read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("ctx_id"), F.col("text").alias("prompt")),
        ["ctx_id"], ordering.bucket_of("ctx_id", 1024), out="p")
    picks = sampling.round_robin(spark.range(SAMPLE_COUNT).withColumnRenamed("id", "i"), "i", prompts, "p")
    chosen = picks.select("ctx_id").distinct()
    sc = prompt_scores(spark, sf_dir).join(chosen, "ctx_id")
    hist = prompt_history(spark, sf_dir).join(chosen, "ctx_id")
    out = None
    for seed in sweep_seeds():
        drawn = scores.sample_next(sc, hist, PROMPT_TEMPERATURE, PROMPT_TOP_K, PROMPT_PENALTY, seed)
        part = picks.join(drawn, "ctx_id").join(vocab, "token_id").select(
            F.lit(seed).alias("seed"), "i", "ctx_id", "prompt", F.concat("prompt", "next_char").alias("text"))
        out = part if out is None else out.unionByName(part)
    return out


def benchmark_runs(spark, sf_dir):
    rep = eval_report_df(spark, sf_dir)
    wide = rep.groupBy("seed").pivot("split", ["train", "val"]).agg(
        F.first("loss").alias("loss"), F.first("perplexity").alias("perplexity"), F.first("bpc").alias("bpc"),
        F.first("top1_accuracy").alias("top1_accuracy"))
    params = char_model(spark, sf_dir).count()
    samples = run_samples(spark, sf_dir).groupBy("seed").agg(
        F.array_sort(F.collect_list(F.struct("i", "prompt", "text"))).alias("_s"))
    speed = {r["split"]: F.lit(r["tokens_per_sec"]) for r in eval_speed(spark, sf_dir).collect()}      # two rows
    runs = sweep_runs(spark).join(wide, "seed").join(samples, "seed", "left")
    return runs.select(
        F.lit("count-model").alias("checkpoint"), "seed", F.lit(params).cast("bigint").alias("params"),
        *[F.col(c) for c in ("d_model", "context_length", "eval_iters", "batch_size")],
        *[F.col(f"{s}_{m}") for s in ("train", "val") for m in ("loss", "perplexity", "bpc", "top1_accuracy")],
        speed["train"].alias("train_tokens_per_sec"), speed["val"].alias("val_tokens_per_sec"),
        F.transform("_s", lambda x: F.struct(x["prompt"].alias("prompt"), x["text"].alias("text"))).alias("samples"),
    )


def landed_log(spark, sf_dir):
    def build():
        runs = benchmark_runs(spark, sf_dir)
        summary = logsrc.summary_log(runs, "seed_sweep", "count-model")
        path = logsrc.write_benchmark_log(summary, _landing_dir(spark, "benchmarks"), "seed_sweep")
        return logsrc.read_benchmark_logs(spark, path)
    return landed(spark, sf_dir, "benchmark_log", build)


@query("benchmark_log")
def q_benchmark_log(spark, sf_dir):
    """SNK5 then SRC9: summary log of the seed sweep written as nested JSON,
    read back as one row per run with flattened metrics."""
    runs = landed_log(spark, sf_dir)
    cols = [f"{s}_{m}" for s in ("train", "val") for m in ("loss", "perplexity", "bpc", "top1_accuracy")]
    timed = (F.col("train_tokens_per_sec") > 0) & (F.col("val_tokens_per_sec") > 0)
    return runs.select("seed", "params", *[r6(c).alias(c) for c in cols], timed.alias("timed"))


@query("sample_text")
def q_sample_text(spark, sf_dir):
    """SRC10: generated samples of the log, distinct texts per prompt across seeds."""
    _, distinct = logsrc.explode_samples(landed_log(spark, sf_dir))
    return distinct.select("prompt", F.col("samples").cast("bigint").alias("samples"),
                           F.col("distinct_texts").cast("bigint").alias("distinct_texts"))


@query("story_files")
def q_story_files(spark, sf_dir):
    """SNK1, SNK3: the stories of each split written as ordered text files, a
    second write left out because the first is complete, and read back in file
    order with their place in the split."""
    out = _landing_dir(spark, "stories")
    d = split_docs(spark, sf_dir)
    for part in (d, d.limit(0)):
        records.write_stories(part, out, ["doc_id", "pos"], mode="once")
    back = records.read_story_files(spark, out)
    # a file split (its start) is a bucket of the scan: the session's split size bounds it
    order = ["file", "block_start", "pos"]
    placed = ordering.ordered_index(back, order, F.struct("file", "block_start"), ["split"], out="idx")
    return placed.select("split", "idx", "story")


@query("tokenizer_files")
def q_tokenizer_files(spark, sf_dir):
    """SNK4, TOK10, TOK3: the tokenizer written as a version and loaded by a
    fresh plan encodes and decodes all stories; those without an unknown byte
    come back as they were."""
    out = _landing_dir(spark, "tokenizer")
    records.save_tokenizer(*bpe_tokenizer(spark, sf_dir), out)
    vocab, merges = records.load_tokenizer(spark, out)
    ids = bpe.bpe_encode(split_docs(spark, sf_dir), vocab, merges, ["doc_id", "pos"], "story")
    whole = ids.filter(~F.array_contains("ids", tok.UNK_ID))
    return bpe.bpe_decode(whole, vocab, "ids").select("doc_id", "pos", "text")


@query("triplet_files")
def q_triplet_files(spark, sf_dir):
    """SNK6: padded triplets written per split and read back."""
    out = _landing_dir(spark, "triplets")
    records.write_triplets(sft_trip(spark, sf_dir), out)
    back = spark.read.parquet(out)
    return back.select("conv_id", "turn", "split", ids_to_string("tokens").alias("tokens"),
                       ids_to_string("targets").alias("targets"), _mask_str("mask").alias("mask"))


# -- streaming forms over the given tables (each run to completion, result read back)



def _run_to_table(df_stream, name: str, mode: str = "complete"):
    """Run a streaming aggregate to completion; every micro-batch overwrites a
    Parquet table in the shared folder with the current result (distributed
    write, nothing held on the driver); the table is read back."""
    spark = df_stream.sparkSession
    table = f"{name}-{uuid.uuid4().hex[:12]}"
    path = _landing_dir(spark, table)

    def sink(batch_df, _batch_id):
        batch_df.write.mode("overwrite").parquet(path)

    q = (df_stream.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", inc.checkpoint_location(spark, table)).start())
    q.processAllAvailable()
    q.stop()
    return spark.read.parquet(path)


def _stream_of(spark, sf_dir, name, max_files=1):
    return (spark.readStream.schema(read(spark, sf_dir, name).schema).option("maxFilesPerTrigger", max_files)
            .option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir))


@query("stream_best")
def q_stream_best(spark, sf_dir):
    """STR3: live best validation loss per run from the log read as a stream
    (state: one row per run); equals the batch best of WIN1/TOP3."""
    ev = _stream_of(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("val_loss"))
    return _run_to_table(inc.live_best(ev), "stream_best")


@query("stream_word_counts")
def q_stream_word_counts(spark, sf_dir):
    """STR4: pre-token counts of the corpus, landed as several files and read
    a quarter of them, ``STREAM_BATCH`` at most, per micro-batch; every batch
    appends its own counts."""
    src, name = _landing_dir(spark, f"documents-{uuid.uuid4().hex[:12]}"), f"stream_word_counts-{uuid.uuid4().hex[:12]}"
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    n = stream_files(docs)
    docs.repartition(n, "doc_id").write.parquet(src)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", batch_files(n, STREAM_PARTS)).parquet(src)
    path = _landing_dir(spark, name)
    inc.append_word_counts(stories.split_stories(stream, "text", sep="\n"), path, inc.checkpoint_location(spark, name))
    return inc.summed_word_counts(spark, path)


STREAM_PARTS = 4         # the streaming queries land their input in so many files for each STREAM_DOCS documents
STREAM_DOCS = 16384
STREAM_BATCH = 32        # files of a micro-batch at most: a larger input has more of them, not larger ones


def stream_files(docs):
    """Files of a streaming input: as many for every ``STREAM_DOCS`` documents."""
    return STREAM_PARTS * max(1, -(-docs.count() // STREAM_DOCS))


def batch_files(n, parts):
    """Files of each micro-batch, of ``n`` in all."""
    return min(n // parts, STREAM_BATCH)


def _streamed_records(spark, sf_dir):
    """The instruction stream landed as several files, built into records by a
    file stream of half of them, ``STREAM_BATCH`` at most, per micro-batch
    (``availableNow``, checkpointed)."""
    docs = read(spark, sf_dir, "documents")
    lines = F.concat(
        F.array(F.concat(F.lit("Features: "), F.col("source")), F.concat(F.lit("Words: "), F.col("lang")),
                F.concat(F.lit("Summary: "), F.element_at(F.split("text", "\n"), 1)), F.lit("Story:")),
        F.split("text", "\n"), F.array(F.lit(blocks.END_OF_TEXT)))
    name = f"stream_records-{uuid.uuid4().hex[:12]}"
    src, out = _landing_dir(spark, f"{name}-in"), _landing_dir(spark, f"{name}-out")
    n = stream_files(docs)
    docs.repartition(n, "doc_id").select(F.array_join(lines, "\n").alias("value")).write.text(src)
    inc.build_records_incrementally(spark, src, out, checkpoint=inc.checkpoint_location(spark, name), max_files=batch_files(n, 2))
    return spark.read.parquet(out).select("prompt", "response"), inc.progress_totals(spark, out)


@query("stream_records")
def q_stream_records(spark, sf_dir):
    """STR1: the records of the stream equal the batch records."""
    return _streamed_records(spark, sf_dir)[0]


@query("stream_progress")
def q_stream_progress(spark, sf_dir):
    """STR2: the counters written with every micro-batch, beside the rows the
    sink holds (one row each)."""
    records_out, totals = _streamed_records(spark, sf_dir)
    return totals.withColumn("stored", F.lit(records_out.count()).cast("bigint"))
