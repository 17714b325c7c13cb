"""Block assembly: instruction records from flat, ordered line streams
(sessionize by a delimiter line), and chat pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip_ws
from .ordering import running_sum

# Fixed values taken from the instruction-data format.
END_OF_TEXT = "<|endoftext|>"
PREFIXES = [("features", "features:"), ("words", "words:"), ("summary", "summary:"), ("story", "story:")]
PROMPT_PARTS = {"features": "with features: ", "words": "using the words: ", "summary": "about: "}
PROMPT_HEAD = "Write a short story"
MIN_STORY_CHARS = 40


def assign_blocks(
    lines: DataFrame,
    src_col: str,
    order_cols: Sequence,
    bucket,
    text_col: str = "text",
    delim: str = END_OF_TEXT,
    block_col: str = "block",
) -> DataFrame:
    """BLK1: block number of every line = delimiters seen before it in its
    source. A (stripped) line equal to ``delim`` closes a block and is removed;
    a trailing block without delimiter counts; empty blocks produce nothing.

    Output keeps the input columns plus ``line`` (the stripped text) and
    ``block``. Uses the two-level prefix sum, so one giant file is spread over
    its buckets instead of landing in one task."""
    d = lines.withColumn("line", strip_ws(F.coalesce(F.col(text_col), F.lit(""))))
    is_delim = (F.col("line") == F.lit(delim)).cast("bigint")
    d = running_sum(d, is_delim, order_cols, bucket, [src_col], out=block_col, inclusive=False)
    return d.filter(F.col("line") != F.lit(delim))


def classify_lines(df: DataFrame, line_col: str = "line") -> DataFrame:
    """PRJ3: case-insensitive prefix match -> (ctype, cval).

    ``features:`` / ``words:`` / ``summary:`` -> constraint with stripped
    remainder; ``story:`` -> ``story`` with stripped remainder; anything else
    -> ``text``. Checked before any in-story test (a story line that starts
    with ``Words:`` is a constraint)."""
    line = F.col(line_col)
    low = F.lower(line)
    ctype = F.lit("text")
    cval = line
    for name, prefix in reversed(PREFIXES):
        ctype = F.when(low.startswith(prefix), F.lit(name)).otherwise(ctype)
        cval = F.when(low.startswith(prefix), strip_ws(F.substring(line, len(prefix) + 1, 1 << 30))).otherwise(cval)
    return df.withColumn("ctype", ctype).withColumn("cval", cval)


def story_lines(df: DataFrame, block_cols: Sequence, order_col: str) -> DataFrame:
    """BLK2: ``in_story`` flag per classified line: true from the first
    ``story:`` line of its block on. The first story line per block is a
    partial aggregation (skew-safe), joined back on the block key."""
    bk = list(block_cols)
    first = df.filter(F.col("ctype") == "story").groupBy(*bk).agg(F.min(order_col).alias("_first_story"))
    d = df.join(first, on=bk, how="left")
    flag = F.coalesce(F.col(order_col) >= F.col("_first_story"), F.lit(False))
    return d.withColumn("in_story", flag).drop("_first_story")


def build_prompt(constraints) -> F.Column:
    """PRJ5: ``Write a short story`` + ``, ``-joined parts in order of
    appearance + ``.``; no parts -> ``Write a short story.``.
    ``constraints``: array<struct<ctype, cval>> in appearance order."""
    def part(c):
        expr = None
        for name, head in PROMPT_PARTS.items():
            piece = F.concat(F.lit(head), c["cval"])
            expr = F.when(c["ctype"] == name, piece) if expr is None else expr.when(c["ctype"] == name, piece)
        return expr

    parts = F.transform(constraints, part)
    return F.when(F.size(parts) == 0, F.lit(PROMPT_HEAD + ".")).otherwise(
        F.concat(F.lit(PROMPT_HEAD + " "), F.array_join(parts, ", "), F.lit("."))
    )


def assemble_records(
    blocked: DataFrame, block_cols: Sequence, order_col: str, min_chars: int = MIN_STORY_CHARS
) -> DataFrame:
    """BLK3: one (prompt, response) record per block.

    ``blocked`` is ``assign_blocks`` output. One shuffle: non-blank lines are
    grouped by block, sorted by their order key inside the group, then the
    story flag, the response (story lines joined by one space) and the prompt
    are computed with array functions. Blocks without story text or with a
    response shorter than ``min_chars`` characters are dropped (PRJ4)."""
    bk = list(block_cols)
    d = classify_lines(blocked.filter(F.col("line") != ""))
    grouped = d.groupBy(*bk).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), "ctype", "cval"))).alias("ls"),
        F.min(order_col).alias("first_line"),
    )
    story_at = F.array_min(F.transform(F.filter("ls", lambda x: x["ctype"] == "story"), lambda x: x["o"]))
    grouped = grouped.withColumn("_s", story_at)
    body = F.filter(
        "ls",
        lambda x: ((x["ctype"] == "story") & (x["cval"] != ""))
        | ((x["ctype"] == "text") & (x["o"] > F.col("_s"))),
    )
    constraints = F.filter("ls", lambda x: x["ctype"].isin("features", "words", "summary"))
    rec = grouped.select(
        *bk,
        "first_line",
        build_prompt(constraints).alias("prompt"),
        F.array_join(F.transform(body, lambda x: x["cval"]), " ").alias("response"),
        F.size(body).alias("_n_story"),
    )
    return filter_min_length(rec.filter(F.col("_n_story") > 0), "response", min_chars).drop("_n_story")


def filter_min_length(df: DataFrame, col: str = "response", n: int = MIN_STORY_CHARS) -> DataFrame:
    """PRJ4: keep rows whose ``col`` has at least ``n`` characters."""
    return df.filter(F.length(F.col(col)) >= F.lit(n))


TURN_BUCKET = 1024      # turns of a conversation that one window sees


def chat_pairs(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """BLK4: each assistant turn with the turn just before it, if that is a
    user turn -> (prompt, response). Turn numbers may have gaps.

    A conversation is looked through in buckets of ``TURN_BUCKET`` turns; the
    first turn of a bucket takes the last one of the bucket before it, found
    over one row per bucket. So a huge conversation does not land in one task."""
    d = conversations.select(conv_col, turn_col, "role", "text", F.floor(F.col(turn_col) / TURN_BUCKET).alias("_b"))
    said = F.struct("role", "text")
    inside = Window.partitionBy(conv_col, "_b").orderBy(turn_col)
    d = d.withColumn("_prev", F.lag(said).over(inside))
    lasts = d.groupBy(conv_col, "_b").agg(F.max_by(said, turn_col).alias("_last"))
    before = lasts.select(conv_col, "_b", F.lag("_last").over(Window.partitionBy(conv_col).orderBy("_b")).alias("_carried"))
    a = d.filter(F.col("role") == "assistant").join(before.filter("_carried is not null"), [conv_col, "_b"], "left")
    prev = F.coalesce("_prev", "_carried")
    return a.filter(prev["role"] == "user").select(conv_col, turn_col, prev["text"].alias("prompt"), F.col("text").alias("response"))


def valid_records(df: DataFrame) -> DataFrame:
    """PRJ6 (rows): records with a non-empty prompt and response."""
    return df.filter((F.coalesce(F.length("prompt"), F.lit(0)) > 0) & (F.coalesce(F.length("response"), F.lit(0)) > 0))


def record_counts(df: DataFrame) -> DataFrame:
    """PRJ6 (counts): written / skipped in one pass; zero counts on empty input."""
    ok = (F.coalesce(F.length("prompt"), F.lit(0)) > 0) & (F.coalesce(F.length("response"), F.lit(0)) > 0)
    return df.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(ok).alias("written"),
        F.count_if(~ok).alias("skipped"),
    )


def full_text(df: DataFrame) -> DataFrame:
    """PRJ7: ``prompt + "\\n\\n" + response`` and the prompt text with the same suffix."""
    return df.withColumn("prompt_text", F.concat("prompt", F.lit("\n\n"))).withColumn(
        "full_text", F.concat("prompt", F.lit("\n\n"), "response")
    )


def _classified_struct(line):
    """(ctype, cval) of one stripped line as a struct (PRJ3 in-row form)."""
    low = F.lower(line)
    ctype = F.lit("text")
    cval = line
    for name, prefix in reversed(PREFIXES):
        ctype = F.when(low.startswith(prefix), F.lit(name)).otherwise(ctype)
        cval = F.when(low.startswith(prefix), strip_ws(F.substring(line, len(prefix) + 1, 1 << 30))).otherwise(cval)
    return F.struct(ctype.alias("ctype"), cval.alias("cval"))


def block_records(df: DataFrame, text_col: str = "value", delim: str = END_OF_TEXT, min_chars: int = MIN_STORY_CHARS) -> DataFrame:
    """BLK1-BLK3 for rows that each hold one block (the text between two
    delimiter lines): adds prompt and response, drops blocks without a record.

    A block's lines are split and classified once: the classified lines and the
    place of the first story line are bound as lambda variables, the lines of the
    story are a slice from that place on (no lambda over lines looks outside its
    own line), and the record leaves through a generator, which no filter can be
    pushed through. So the work is linear in the text."""
    lines = F.filter(F.transform(F.split(F.col(text_col), "\n"), lambda x: strip_ws(x)), lambda x: x != "")

    def record(ls, at):
        story = F.slice(ls, F.greatest(at, F.lit(1)), F.when(at > 0, F.size(ls)).otherwise(F.lit(0)))
        body = F.filter(story, lambda x: (x["ctype"] == "text") | ((x["ctype"] == "story") & (x["cval"] != "")))
        constraints = F.filter(ls, lambda x: x["ctype"].isin("features", "words", "summary"))
        return F.struct(build_prompt(constraints).alias("prompt"), F.transform(body, lambda x: x["cval"]).alias("body"))

    def bound(ls):
        at = F.array_position(F.transform(ls, lambda x: x["ctype"]), F.lit("story")).cast("int")
        return F.transform(F.array(at), lambda a: record(ls, a))[0]

    found = F.filter(F.transform(F.array(F.transform(lines, _classified_struct)), bound), lambda r: F.size(r["body"]) > 0)
    joined = F.transform(found, lambda r: F.struct(r["prompt"].alias("prompt"), F.array_join(r["body"], " ").alias("response")))
    return df.select("*", F.inline(F.filter(joined, lambda r: F.length(r["response"]) >= F.lit(min_chars))))
