"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document is the distribution of its hashed tokens: the shape of each word
(letter case, digits and punctuation with runs shortened), the same with a mark
when the word repeats one of the words shortly before, the word itself, and
bands of length and of distinct words. One weight vector is shared by all
grades; ordered thresholds cut the latent score:

    P(grade > k) = sigmoid(w x - threshold_k),  threshold_0 <= threshold_1 <= ...

so a document gets an expected grade and the tail probability of a wanted grade.
The fit runs in one task over a bounded sample (``per_grade`` documents of each
grade, chosen by a hash of their id).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .toxicity import bounded_sample

BITS = 14                 # hashed feature space: 2**14 slots
PER_GRADE = 3000          # labelled documents of each grade in the fit
RIDGE = 1e-4
STEPS = 400
NEAR_WORDS = 8            # a word counts as repeated if it is one of the last 8
WORD_SCALE = 0.25         # weight of plain words against shapes

_KIND = np.arange(256, dtype=np.uint8)
_KIND[0x41:0x5B] = ord("A")
_KIND[0x61:0x7B] = ord("a")
_KIND[0x80:] = ord("a")
_KIND[0x30:0x3A] = ord("9")


def _slot(h: np.ndarray, salt: int) -> np.ndarray:
    return (tb.mix(h + np.uint64(salt)) >> np.uint64(64 - BITS)).astype(np.int64)


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (row, slot, value). Values are square roots of shares, so
    every row has a bounded norm whatever its length."""
    n = len(offs) - 1
    s, e, first = tb.word_spans(buf, offs, tb.NOT_SPACE)
    words = np.diff(first)
    row = np.repeat(np.arange(n), words)
    h = tb.span_hashes(buf, s, e)
    # shapes: runs of one kind shortened to two
    kind = _KIND[buf]
    keep = np.ones(len(buf), bool)
    if len(buf) > 2:
        keep[2:] = (kind[2:] != kind[1:-1]) | (kind[1:-1] != kind[:-2])
    at = np.r_[0, np.cumsum(keep)]
    shape = tb.span_hashes(kind[keep], at[s], at[e], lower=False)
    again = np.zeros(len(h), bool)
    for back in range(1, NEAR_WORDS + 1):
        if len(h) > back:
            again[back:] |= (h[back:] == h[:-back]) & (row[back:] == row[:-back])
    pair = np.concatenate([
        row << BITS | _slot(shape, 1),
        row[again] << BITS | _slot(np.zeros(int(again.sum()), np.uint64), 2),
    ])
    w = row << BITS | _slot(h, 3)
    key, count = np.unique(pair, return_counts=True)
    wkey, wcount = np.unique(w, return_counts=True)
    per = np.maximum(words, 1)
    value = np.sqrt(count / per[key >> BITS])
    wvalue = WORD_SCALE * np.sqrt(wcount / per[wkey >> BITS])
    length = np.log2(words + 1.0).astype(np.int64)
    distinct = np.bincount(wkey >> BITS, minlength=n)
    variety = np.minimum((10 * distinct / per).astype(np.int64), 10) * 8 + np.minimum(length // 2, 7)
    band = lambda v, salt: np.arange(n) << BITS | _slot(v.astype(np.uint64), salt)
    rows = np.concatenate([key, wkey, band(length, 4), band(variety, 5)])
    return rows >> BITS, rows & ((1 << BITS) - 1), np.concatenate([value, wvalue, np.full(2 * n, 0.3)])


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, buf, offs in tb.blocks(batches):
        row, slot, value = features(buf, offs)
        order = np.argsort(row, kind="stable")
        ends = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_arrays([
            batch.column(0),
            tb.list_column(slot[order].astype(np.int32), ends, pa.int32()),
            tb.list_column(value[order].astype(np.float32), ends, pa.float32()),
        ], ["label", "slots", "values"])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(grade: np.ndarray, slots: list[np.ndarray], values: list[np.ndarray], grades: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the cumulative-link model. Thresholds are the
    first one plus positive gaps, so they are ordered at every step."""
    n = len(grade)
    row = np.repeat(np.arange(n, dtype=np.int32), [len(s) for s in slots])
    slot, value = np.concatenate(slots).astype(np.int32), np.concatenate(values).astype(np.float32)
    count = np.bincount(grade, minlength=grades)
    weight = 1.0 / (np.maximum(count, 1)[grade] * max((count > 0).sum(), 1))   # grades count alike
    size = 1 << BITS
    w = np.zeros(size)
    raw = np.r_[0.0, np.full(grades - 2, 0.5)] if grades > 1 else np.zeros(0)  # first threshold, log gaps
    m, v = np.zeros(size + len(raw)), np.zeros(size + len(raw))
    for i in range(1, STEPS + 1):
        theta = np.cumsum(np.r_[raw[:1], np.exp(raw[1:])])
        z = np.bincount(row, weights=w[slot] * value, minlength=n)
        tail = _sigmoid(z[:, None] - theta[None, :])
        edge = np.c_[np.ones(n), tail, np.zeros(n)]
        p = np.maximum(edge[np.arange(n), grade] - edge[np.arange(n), grade + 1], 1e-12)
        d = np.c_[np.zeros(n), tail * (1 - tail), np.zeros(n)]
        dz = -weight * (d[np.arange(n), grade] - d[np.arange(n), grade + 1]) / p
        gt = np.zeros((n, grades + 1))
        gt[np.arange(n), grade] = weight * d[np.arange(n), grade] / p
        gt[np.arange(n), grade + 1] -= weight * d[np.arange(n), grade + 1] / p
        gtheta = gt[:, 1:grades].sum(axis=0)
        graw = np.cumsum(gtheta[::-1])[::-1]
        graw = np.r_[graw[:1], graw[1:] * np.exp(raw[1:])]
        g = np.r_[np.bincount(slot, weights=dz[row] * value, minlength=size) + RIDGE * w, graw]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-6)
        w, raw = w - step[:size], raw - step[size:]
    return w, np.cumsum(np.r_[raw[:1], np.exp(raw[1:])])


def _fit_group(grades: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pick")
        w, theta = fit(rows["label"].to_numpy(), [np.asarray(x) for x in rows["slots"]], [np.asarray(x) for x in rows["values"]], grades)
        used = np.flatnonzero(w)
        return pd.DataFrame({"slot": np.r_[-1 - np.arange(len(theta)), used], "weight": np.r_[theta, w[used]]})
    return run


def train(docs: DataFrame, ratings: DataFrame, *, grades: int, grade: str = "grade", per_grade: int = PER_GRADE) -> list[tuple[int, float]]:
    """[(slot, weight)] of the fitted model; slots -1, -2, ... are the ordered
    thresholds. ``ratings`` has doc_id and grades 0 .. grades - 1 (null: not
    rated; of several ratings of an id the largest counts). At most 2**BITS +
    ``grades`` rows come to the driver; empty without rated documents."""
    if grades < 2:
        raise ValueError("a grading has two grades at least")
    sample = bounded_sample(ratings, grade, per_grade)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # bounded: per_grade ids of each grade
    rows = texts.select(F.struct("label", F.xxhash64("doc_id").alias("pick")).alias("label"), "text")
    rows = rows.mapInArrow(_training_rows, "label struct<label:int,pick:long>, slots array<int>, values array<float>")
    rows = rows.select("label.label", "label.pick", "slots", "values", F.lit(0).alias("one"))
    model = rows.groupBy("one").applyInPandas(_fit_group(grades), "slot long, weight double")
    return [(r["slot"], r["weight"]) for r in model.collect()]


def _score_rows(model: list[tuple[int, float]], wanted: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(1 << BITS)
        theta = {}
        for slot, x in model:
            if slot < 0:
                theta[-1 - slot] = x
            else:
                weight[slot] = x
        cut = np.array([theta[k] for k in sorted(theta)])
        for batch, buf, offs in tb.blocks(batches):
            n = batch.num_rows
            if len(cut):
                row, slot, value = features(buf, offs)
                z = np.bincount(row, weights=weight[slot] * value, minlength=n)
                tail = _sigmoid(z[:, None] - cut[None, :])
            else:                                     # nothing was rated: nothing is known against a text
                tail = np.ones((n, max(wanted, 1)))
            empty = np.diff(offs) == 0
            tail[empty] = 0.0
            yield pa.RecordBatch.from_arrays(
                [*batch.drop_columns(["text"]).columns, pa.array(tail.sum(axis=1)), pa.array(tail[:, wanted - 1])],
                [*[c for c in batch.schema.names if c != "text"], "expected_grade", "tail"])
    return run


def score(docs: DataFrame, model: list[tuple[int, float]], wanted: int = 1, least: float = 0.5,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, expected_grade, tail, selected) for every row: ``tail`` is
    P(grade >= wanted), ``selected`` says that it reaches ``least``.

    Null and empty texts have grade 0 (not selected). Null ids and repeated
    rows are scored row for row. Without a model every text with bytes is
    selected. Columns beyond id and text are not read."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    out = d.mapInArrow(_score_rows(model, wanted), f"id {kind}, expected_grade double, tail double")
    return out.select(F.col("id").alias(id_col), "expected_grade", "tail", (F.col("tail") >= least).alias("selected"))


def graded(labels: DataFrame) -> DataFrame:
    """Ratings of the labels table: 0 for poor quality, 1 for good but toxic,
    2 for good and not toxic."""
    good = F.col("quality").cast("int")
    return labels.select("doc_id", (good * (2 - F.coalesce(F.col("toxic").cast("int"), F.lit(0)))).alias("grade"))


def select_documents(docs: DataFrame, model: list[tuple[int, float]], wanted: int = 1, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model selects, all columns as they are.
    One pass: the rows are judged where they are read, without a join."""
    columns = [c for c in docs.columns if c != text_col]
    d = docs.select(F.struct(*[F.col(c) for c in columns], F.col(text_col).alias("__raw")).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = d.mapInArrow(_score_rows(model, wanted), f"id {d.schema['id'].dataType.simpleString()}, expected_grade double, tail double")
    out = out.where(F.col("tail") >= least)
    return out.select(*[F.col("id.__raw").alias(c) if c == text_col else F.col(f"id.`{c}`").alias(c) for c in docs.columns])
