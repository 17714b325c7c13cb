"""Suffix-array dedup over a sparse set of suffixes.

Word positions whose k-gram hash is the smallest of some window of W positions
(minimisers) are retained: two equal passages of k + W - 1 words retain the same
places. The retained suffixes are brought into the order of their first k words;
a suffix whose neighbours in that order begin alike in no other document goes.
Around the others every window of ``min_words`` words that selected them is
brought into order the same way; equal neighbours are matches of ``min_words``
words, and runs of matched windows extend them left and right to whole repeated
passages. So a passage of at least ``min_words`` words is found exactly when it
occurs in two documents, wherever it begins.

The orders are those of 64-bit hashes of the compared words, so equal beginnings
are one key of an aggregate: a passage in a million documents is counted before
the shuffle and never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .shared import land

MIN_WORDS = 50
GRAM = 16               # words by which retained suffixes are compared first


def _slide(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over every w consecutive values, by doubling."""
    size = 1
    while 2 * size <= w:
        x = f(x[:-size], x[size:])
        size *= 2
    return f(x[:len(x) - (w - size)], x[w - size:]) if w > size else x


def selected(h: np.ndarray, min_words: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(k-gram hash that each window of ``min_words`` words selects, window
    hashes) of one text's word hashes."""
    if len(h) < min_words:
        return h[:0], h[:0]
    return _slide(tb.kgram_hashes(h, gram), min_words - gram + 1, np.minimum), tb.kgram_hashes(h, min_words)


def _texts(buf: np.ndarray, offs: np.ndarray, min_words: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    s, e, first = tb.word_spans(buf, offs, tb.NOT_SPACE)
    h = tb.span_hashes(buf, s, e)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield selected(h[a:b], min_words, gram)


def _retained(min_words: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, buf, offs in tb.blocks(batches):
            s, e, first = tb.word_spans(buf, offs, tb.NOT_SPACE)
            h = tb.span_hashes(buf, s, e)
            keys = [np.unique(selected(h[a:b], min_words, gram)[0]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            ends = np.r_[0, np.cumsum([len(k) for k in keys])]
            flat = tb.signed(np.concatenate(keys))
            yield pa.RecordBatch.from_arrays(
                [*batch.drop_columns(["text"]).columns, pa.array(np.diff(first), pa.int32()), tb.list_column(flat, ends, pa.int64())],
                ["id", "v", "t1", "t2", "n_words", "keys"])
    return run


def _windows(min_words: int, gram: int) -> Callable:
    """The windows around the suffixes that stay: (id, v, copied, start, hash)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, buf, offs in tb.blocks(batches):
            stay = batch.column(batch.schema.get_field_index("stay"))
            copied = batch.column(batch.schema.get_field_index("copied")).to_numpy(zero_copy_only=False)
            row, start, hashes = [], [], []
            for i, (picked, window) in enumerate(_texts(buf, offs, min_words, gram)):
                if not len(picked):
                    continue
                if copied[i]:
                    at = np.arange(len(picked))
                else:
                    keys = np.sort(stay[i].values.to_numpy(zero_copy_only=False).view(np.uint64))
                    at = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, picked), len(keys) - 1)] == picked)
                row.append(np.full(len(at), i))
                start.append(at)
                hashes.append(window[at])
            if not row:
                continue
            r = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(r), batch.column(1).take(r), pa.array(copied).take(r),
                pa.array(np.concatenate(start), pa.int32()), pa.array(tb.signed(np.concatenate(hashes)), pa.int64()),
            ], ["id", "v", "copied", "start", "hash"])
    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows in the order of (hash, id, v, start): the windows that another
    document has, and whether each is the first of its kind. A run is passed
    row by row; only rows of its first document wait, until another is met."""
    names = ["hash", "id", "v", "start", "copied"]
    held = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.int32), np.zeros(0, bool)]
    last, known, head = None, False, None   # the open run, whether its rows are known to repeat, its first row
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
        h, ident, v, start, copied = (np.concatenate([a, b]) for a, b in zip(held, new, strict=True))
        cut = np.r_[0, np.flatnonzero(h[1:] != h[:-1]) + 1]
        run = np.zeros(len(h), np.int64)
        run[cut[1:]] = 1
        run = np.cumsum(run)
        heads = np.stack([ident[cut], v[cut], start[cut]])
        if known and h[0] == last:     # the run began in an earlier batch
            heads[:, 0] = head
        lead = (np.stack([ident, v, start]) == heads[:, run]).all(axis=0)   # repeated rows are one
        many = np.maximum.reduceat((ident != ident[cut][run]) | copied, cut)
        if known and h[0] == last:
            many[0] = True
        give = many[run]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ident[give], pa.int64()), pa.array(v[give].astype(np.int32), pa.int32()), pa.array(start[give], pa.int32()), pa.array(lead[give])],
            ["id", "v", "start", "first"])
        last, known, head = h[-1], bool(many[-1]), heads[:, -1]
        wait = (run == run[-1]) & ~give
        held = [x[wait] for x in (h, ident, v, start, copied)]


def _spans(min_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vs, lo, hi, kept = [], [], [], [], []
            for i, ident, v, found in zip(range(batch.num_rows), batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                start = found.values.field("start").to_numpy()
                first = found.values.field("first").to_numpy(zero_copy_only=False)
                for flag in (False, True):
                    s = np.unique(start[first == flag])
                    if len(s):
                        gap = np.flatnonzero(s[1:] > s[:-1] + min_words)
                        lo += s[np.r_[0, gap + 1]].tolist()
                        hi += (s[np.r_[gap, len(s) - 1]] + min_words).tolist()
                        ids += [ident] * (len(gap) + 1)
                        vs += [v] * (len(gap) + 1)
                        kept += [flag] * (len(gap) + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(vs, pa.int32()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(kept, pa.bool_())],
                ["id", "v", "start_word", "end_word", "kept"])
    return run


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return d.where("id is not null").withColumn("v", F.hash("text"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                      min_words: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """(id, v, start_word, end_word, kept): the maximal runs of words that are
    covered by windows of ``min_words`` words which two documents (ids) have.

    Words end at ASCII white space, A-Z lower-cased. ``kept`` spans hold the
    windows whose first occurrence (smallest id, then place) is here, the others
    repeat an earlier one; the two kinds may overlap at their ends. ``v`` tells
    texts of one id apart (a hash of the text); repeats inside one document
    alone do not count. Rows with a null id take no part; null, empty and
    shorter texts have no spans; an empty table gives an empty result. Columns
    beyond id and text are not read."""
    if not 1 <= gram <= min_words:
        raise ValueError("gram must be between 1 and min_words")
    d = _identified(docs, id_col, text_col)
    marked = d.select("id", "v", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2"), "text")
    base = land(marked.mapInArrow(_retained(min_words, gram), "id long, v int, t1 long, t2 long, n_words int, keys array<long>"))
    base = base.where(F.col("n_words") >= min_words)
    # equal texts are one class, spoken for by its smallest id
    classes = base.groupBy("t1", "t2").agg(F.min(F.struct("id", "v")).alias("rep"), F.max("id").alias("hi"))
    named = base.join(classes, ["t1", "t2"])
    copies = named.where("id <> rep.id").select("id", "v", F.lit(0).cast("long").alias("start_word"),
                                                F.col("n_words").cast("long").alias("end_word"), F.lit(False).alias("kept")).distinct()
    reps = land(named.where("id = rep.id").select("id", "v", (F.col("hi") > F.col("id")).alias("copied"), "keys").dropDuplicates(["id", "v"]))
    suffixes = reps.select("id", "v", F.explode("keys").alias("key"))
    alike = suffixes.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key")
    stay = suffixes.join(alike, "key").groupBy("id", "v").agg(F.collect_list("key").alias("stay"))
    stay = reps.select("id", "v", "copied").join(stay, ["id", "v"], "left").where("copied or stay is not null")
    texts = d.join(land(stay), ["id", "v"]).select("id", "v", "copied", "stay", "text")
    window = texts.mapInArrow(_windows(min_words, gram), "id long, v int, copied boolean, start int, hash long")
    window = window.repartition("hash").sortWithinPartitions("hash", "id", "v", "start")
    found = window.mapInArrow(_neighbours, "id long, v int, start int, first boolean")
    runs = found.groupBy("id", "v").agg(F.collect_list(F.struct("start", "first")).alias("found"))
    spans = runs.select("id", "v", "found").mapInArrow(_spans(min_words), "id long, v int, start_word long, end_word long, kept boolean")
    return spans.unionByName(copies).withColumnRenamed("id", id_col)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = None
    for batch, buf, offs in tb.blocks(batches, "__text"):
        at = batch.schema.get_field_index("__text")
        cuts = batch.column(batch.schema.get_field_index("__cuts"))
        s, e, first = tb.word_spans(buf, offs, tb.NOT_SPACE)
        out = []
        for i in range(batch.num_rows):
            own = cuts[i]
            if not own.is_valid:
                out.append(None if not batch.column(at)[i].is_valid else buf[offs[i]:offs[i + 1]].tobytes().decode())
                continue
            keep = np.ones(offs[i + 1] - offs[i], bool)
            lo = own.values.field(0).to_numpy()
            hi = own.values.field(1).to_numpy()
            n = first[i + 1] - first[i]
            for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
                left = s[first[i] + a] - offs[i] if a else 0
                right = s[first[i] + b] - offs[i] if b < n else len(keep)   # with the white space after it
                keep[left:right] = False
            out.append(buf[offs[i]:offs[i + 1]][keep].tobytes().decode())
        columns = list(batch.columns)
        columns[at] = pa.array(out, pa.string())
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema.set(at, pa.field("__text", pa.string())))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with every passage cut that repeats an earlier one; the first
    occurrence stays. A text of which nothing is left goes. Rows without a
    repeated passage stay as they are, null ids and null texts included."""
    spans = repeated_passages(docs, id_col, text_col, **settings).where("not kept")
    cuts = spans.groupBy(F.col(id_col).cast("long").alias("__id"), F.col("v").alias("__v")).agg(
        F.collect_list(F.struct("start_word", "end_word")).alias("__cuts"))
    text = F.col(text_col).cast("string")
    d = docs.withColumn("__text", text).withColumn("__v", F.hash(F.coalesce(text, F.lit("")))).withColumn("__id", F.col(id_col).cast("long"))
    joined = d.join(cuts, ["__id", "__v"], "left").select(*[F.col(c) for c in docs.columns if c != text_col], "__text", "__cuts")
    schema = joined.schema
    done = joined.mapInArrow(_cut, schema)
    done = done.where(F.col("__cuts").isNull() | (F.trim(F.col("__text")) != ""))
    return done.select(*[F.col("__text").alias(text_col) if c == text_col else F.col(c) for c in docs.columns])
