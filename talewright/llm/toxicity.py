"""Counterfactual-regularised toxicity classifier.

A document is the set of its hashed words and word beginnings. A logistic model
over the most telling of these features is fitted to labelled documents, with a
penalty on the change of its score when an identity term in a labelled document
is swapped for another term of its kind: a neutral mention of a group must not
move the score, so groups that happen to be attacked often are not learned as
toxic themselves.

The fit runs in one Spark task over a bounded sample (``per_class`` documents of
each label, chosen by a hash of their id); scoring is one pass over the corpus
with a weight table of fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textbytes as tb

BITS = 18                       # hashed feature space: 2**18 slots
BEGINNINGS = (4, 5, 6, 7)       # word beginnings, in bytes
PER_CLASS = 4000                # labelled documents of each label in the fit
MAX_FEATURES = 1500             # features of the fitted model
MIN_CHI2 = 25.0
RIDGE = 2e-4
SWAP_WEIGHT = 1.0               # weight of the counterfactual penalty

#: Identity terms by kind; a term is swapped for the others of its kind.
IDENTITY = {
    "faith": ["christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"],
    "origin": ["african", "american", "asian", "european", "mexican", "chinese", "indian", "arab", "german", "french", "spanish"],
    "colour": ["black", "white", "brown", "latino", "hispanic"],
    "gender": ["women", "men", "woman", "man", "female", "male", "transgender", "nonbinary"],
    "orientation": ["gay", "lesbian", "bisexual", "straight", "queer", "heterosexual"],
    "ability": ["disabled", "blind", "deaf", "autistic"],
    "age": ["young", "old", "elderly", "teenage"],
}


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot) of every word and word beginning, and (row, hash) of the words."""
    s, e, first = tb.word_spans(buf, offs, tb.ALNUM)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    h = tb.span_hashes(buf, s, e)
    rows, slots = [row], [_slots(h)]
    for n in BEGINNINGS:
        long = e - s > n
        rows.append(row[long])
        slots.append(_slots(tb.mix(tb.span_hashes(buf, s[long], s[long] + n) + np.uint64(n))))
    return np.concatenate(rows), np.concatenate(slots), row, h


def term_features(term: str) -> np.ndarray:
    buf = np.frombuffer(term.encode(), np.uint8)
    return np.unique(features(buf, np.array([0, len(buf)]))[1])


TERMS = [(kind, t) for kind, ts in IDENTITY.items() for t in ts]


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = tb.span_hashes(*_terms_buffer())
    order = np.argsort(known)
    for batch, buf, offs in tb.blocks(batches):
        row, slot, word_row, h = features(buf, offs)
        pair = np.unique(row << BITS | slot)
        r = pair >> BITS
        at = np.minimum(np.searchsorted(known[order], h), len(known) - 1)
        hit = known[order][at] == h
        held = np.unique(word_row[hit] * len(known) + order[at[hit]])
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([
            batch.column(0),
            tb.list_column((pair & ((1 << BITS) - 1)).astype(np.int32), np.searchsorted(r, np.arange(n + 1)), pa.int32()),
            tb.list_column((held % len(known)).astype(np.int32), np.searchsorted(held // len(known), np.arange(n + 1)), pa.int32()),
        ], ["label", "slots", "terms"])


def _terms_buffer() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    text = " ".join(t for _, t in TERMS).encode()
    buf = np.frombuffer(text, np.uint8)
    s, e, _ = tb.word_spans(buf, np.array([0, len(buf)]), tb.ALNUM)
    return buf, s, e


def fit(labels: np.ndarray, slots: list[np.ndarray], terms: list[np.ndarray], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, weights, intercept) of the penalised logistic model."""
    y = labels.astype(np.float64)
    n, pos = len(y), y.sum()
    if not 0 < pos < n:                       # one label only: a constant score
        return np.zeros(0, np.int64), np.zeros(0), 4.0 if n and pos == n else -4.0
    flat = np.concatenate(slots)
    size = np.array([len(s) for s in slots])
    row = np.repeat(np.arange(n), size)
    total = np.bincount(flat, minlength=1 << BITS)
    with_pos = np.bincount(flat, weights=y[row], minlength=1 << BITS)
    expected = total * (pos / n)
    chi2 = (with_pos - expected) ** 2 / np.maximum(expected * (1 - pos / n) * (1 - total / n), 1e-9)
    chi2[(total < 5) | (chi2 < MIN_CHI2)] = 0
    chosen = np.argsort(-chi2, kind="stable")[:MAX_FEATURES]
    chosen = np.sort(chosen[chi2[chosen] > 0])
    column = np.full(1 << BITS, -1)
    column[chosen] = np.arange(len(chosen))
    x = np.zeros((n, len(chosen)), np.float32)
    at = column[flat]
    x[row[at >= 0], at[at >= 0]] = 1
    # every label counts as often as it does among all labelled rows
    weight = np.where(y > 0, prior / pos, (1 - prior) / (n - pos))
    # swap term a for term b of its kind: the change of the feature vector
    seen = np.bincount(np.concatenate(terms) if terms else np.zeros(0, int), minlength=len(TERMS)) + 1.0
    swaps, share = [], []
    for a, (kind, ta) in enumerate(TERMS):
        for b, (other, tb_) in enumerate(TERMS):
            if a != b and kind == other:
                d = np.zeros(len(chosen))
                fa, fb = column[term_features(ta)], column[term_features(tb_)]
                d[fb[fb >= 0]] += 1
                d[fa[fa >= 0]] -= 1
                if d.any():
                    swaps.append(d)
                    share.append(seen[a] / n)
    swap = np.array(swaps).reshape(len(swaps), len(chosen))
    share = np.array(share)
    w, b = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    vw, vb = w.copy(), b
    lipschitz = 0.25 * float((weight * (1 + x.sum(axis=1))).sum()) + RIDGE
    if len(swap):
        lipschitz += SWAP_WEIGHT * float((share[:, None] * swap ** 2).sum())
    step, t = 1.0 / lipschitz, 1.0
    for _ in range(600):
        p = 1 / (1 + np.exp(-np.clip(x @ vw + vb, -30, 30)))
        g = weight * (p - y)
        gw = g @ x + RIDGE * vw
        if len(swap):
            gw += SWAP_WEIGHT * ((share * (swap @ vw)) @ swap)
        nw, nb = vw - step * gw, vb - step * float(g.sum())
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        vw, vb = nw + (t - 1) / t2 * (nw - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = nw, nb, t2
    return chosen, w, b


def _fit_group(prior: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pick")
        s = [np.asarray(v, np.int64) for v in rows["slots"]]
        t = [np.asarray(v, np.int64) for v in rows["terms"]]
        slot, w, b = fit(rows["label"].to_numpy(), s, t, prior)
        return pd.DataFrame({"slot": np.r_[-1, slot], "weight": np.r_[b, w]})
    return run


def bounded_sample(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label): at most ``per_class`` ids of each label, those with the
    smallest hash. One row per id (its largest label); null ids or labels do
    not count. A share of the ids, set by the count of their label so that
    about twice ``per_class`` are left, is ranked; so the ranking of a label
    holds as many rows for any number of labelled documents."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    one = one.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    one = one.withColumn("hash", F.xxhash64("doc_id"))
    # one row per label: the ids stay where they are until a share of them is left
    counts = one.groupBy("label").agg(F.count("*").alias("n"))
    share = (2.0 * per_class + 200.0) / F.col("n")
    some = one.join(F.broadcast(counts), "label").where(F.pmod("hash", F.lit(1 << 20)) < share * (1 << 20))
    order = Window.partitionBy("label").orderBy(F.pmod("hash", F.lit(1 << 20)), "hash", "doc_id")
    return some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_class).select("doc_id", "label")


def held_out(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", per_class: int = PER_CLASS) -> list[tuple[int, float]]:
    """[(slot, weight)] fitted on labelled, not held-out documents; slot -1 is
    the intercept. At most ``MAX_FEATURES`` + 1 rows come to the driver."""
    usable = labels.where(~held_out("doc_id"))
    sample = bounded_sample(usable, label, per_class)
    share = usable.where(F.col(label).isNotNull()).agg(F.avg(F.col(label).cast("double")).alias("p")).first()["p"]
    prior = min(max(share if share is not None else 0.0, 1e-3), 1 - 1e-3)
    # bounded by 2 * per_class ids
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = texts.select(F.struct("label", F.xxhash64("doc_id").alias("pick")).alias("label"), "text")
    rows = rows.mapInArrow(_training_rows, "label struct<label:int,pick:long>, slots array<int>, terms array<int>")
    rows = rows.select("label.label", "label.pick", "slots", "terms")
    # the sample is bounded, so one group holds it
    model = rows.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(_fit_group(prior), "slot long, weight double")
    got = [(r["slot"], r["weight"]) for r in model.collect()]
    return got or [(-1, float(np.log(prior / (1 - prior))))]


def _score_rows(model: list[tuple[int, float]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(1 << BITS)
        used = np.zeros(1 << BITS, bool)
        bias = 0.0
        for slot, w in model:
            if slot < 0:
                bias = w
            else:
                weight[slot], used[slot] = w, True
        for batch, buf, offs in tb.blocks(batches):
            row, slot, _, _ = features(buf, offs)
            keep = used[slot]
            pair = np.unique(row[keep] << BITS | slot[keep])
            z = bias + np.bincount(pair >> BITS, weights=weight[pair & ((1 << BITS) - 1)], minlength=batch.num_rows)
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["id", "score"])
    return run


def score(docs: DataFrame, model: list[tuple[int, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row.

    The whole text is scored; a null or empty text gets the intercept's score.
    Null ids stay (``held_out`` is then null), repeated rows are scored row for
    row, columns beyond id and text are not read. Without labelled rows, or
    with one label only, the score is the same for every text.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    out = d.mapInArrow(_score_rows(model), f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
