"""Hard-negative mining by Fagin's threshold algorithm.

Scores are integer inner products with an anchor. A shard of rows keeps one
list per dimension, sorted by that component. For an anchor the lists are read
from the end that its sign favours (sorted access); every row met for the first
time gets its full integer score (random access). The components last read,
times the anchor's, sum up to a threshold that no row still unseen can exceed.
A window of scores is complete as soon as the threshold falls strictly below
its k-th best score (strictly, as equal scores are ordered by id), or below its
lower end, where nothing more can belong to it.

Plan: (1) the rows of each label are dealt into shards of bounded size, each
shard meets the anchors of its label in blocks of bounded size, and the best of
all shards are merged to the anchor's positives; (2) every positive gives a
window of scores; all rows are dealt into shards, which give their best rows of
other labels for each window of each anchor; (3) the best of all shards are
merged per anchor and window. What a shard returns is bounded by k rows for
each window, so a hot label or a huge table only means more shards.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import land

SHARD_ROWS = 8192
BLOCK_ANCHORS = 4096
FIRST_DEPTH = 16           # rows read from every list before the first look at the threshold
LIMIT = 1 << 26            # components of this size and more are out of range

FOUND = pa.schema([("anchor_id", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class Shard:
    """Rows with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.labels, self.rows = ids, labels, rows
        self.lists = np.argsort(rows, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(rows.T, self.lists, axis=1)

    def best(self, anchor: np.ndarray, usable: Callable[[np.ndarray], np.ndarray], windows: list[tuple[int, int]],
             k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(positions, scores) of the first ``k`` usable rows of every window
        lo <= score <= hi, by score downwards, then id."""
        n = len(self.ids)
        down, up = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen = np.zeros(n, bool)
        at, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, open_windows = 0, windows
        while True:
            to = min(n, max(FIRST_DEPTH, 2 * depth))
            if not len(down) and not len(up):
                to = n                           # a zero anchor has no list to read: all scores are 0
                fresh = ~seen
            else:
                fresh = np.zeros(n, bool)
                fresh[self.lists[down, n - to:n - depth]] = True
                fresh[self.lists[up, depth:to]] = True
                fresh &= ~seen
            new = np.flatnonzero(fresh)
            seen[new] = True
            new = new[usable(new)]
            at, score = np.r_[at, new], np.r_[score, self.rows[new] @ anchor]
            depth = to
            if depth == n:
                break
            threshold = int(anchor[down] @ self.values[down, n - depth]) + int(anchor[up] @ self.values[up, depth - 1])
            open_windows = [w for w in open_windows if not self._complete(score, w, k, threshold)]
            if not open_windows:
                break
        out = []
        for lo, hi in windows:
            own = np.flatnonzero((score >= lo) & (score <= hi))
            own = own[np.lexsort((self.ids[at[own]], -score[own]))[:k]]
            out.append((at[own], score[own]))
        return out

    @staticmethod
    def _complete(score: np.ndarray, window: tuple[int, int], k: int, threshold: int) -> bool:
        lo, hi = window
        if threshold < lo:
            return True
        own = score[(score >= lo) & (score <= hi)]
        return len(own) >= k and threshold < np.partition(own, len(own) - k)[len(own) - k]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _search(k: int, same_label: bool) -> Callable:
    """Best rows of a shard for each window of each anchor of a block: of the
    anchor's label (the anchor itself left out), or of the other labels."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return FOUND.empty_table()
        shard = Shard(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["q"]))
        parts: list[list[np.ndarray]] = []
        for own, label, q, windows in zip(anchors["anchor"].to_pylist(), anchors["anchor_label"].to_pylist(), _matrix(anchors["anchor_q"]),
                                          anchors["windows"].to_pylist(), strict=True):
            if same_label:
                usable = lambda p: (shard.labels[p] == label) & (shard.ids[p] != own)  # noqa: E731,B023
            else:
                usable = lambda p: shard.labels[p] != label  # noqa: E731,B023
            bounds = [(w["lo"], w["hi"]) for w in windows]
            for (lo, hi), (at, score) in zip(bounds, shard.best(q, usable, bounds, k), strict=True):
                parts.append([np.full(len(at), own), np.full(len(at), lo), np.full(len(at), hi), shard.ids[at], score])
        if not parts:
            return FOUND.empty_table()
        return pa.Table.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts, strict=True)], schema=FOUND)
    return run


def _deal(n: Column, size: int, salt: int) -> tuple[Column, Column]:
    """(number of shards for ``n`` rows, the shard of a row)."""
    shards = F.greatest(F.lit(1), F.ceil(n / F.lit(size))).cast("int")
    return shards, F.pmod(F.xxhash64("vec_id", F.lit(salt)), shards).cast("int")


def _best(rows: DataFrame, anchors: DataFrame, keys: list[str], k: int, same_label: bool) -> DataFrame:
    """Every shard of rows (columns ``keys``, n_rows, n_anchors) against every
    block of anchors (the same) with equal keys; the first ``k`` per window."""
    shards, shard = _deal(F.col("n_rows"), SHARD_ROWS, 1)
    blocks, block = _deal(F.col("n_anchors"), BLOCK_ANCHORS, 2)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    group = [*keys, "s", "b"]
    left = rows.select(*keys, shard.alias("s"), every(blocks).alias("b"), "vec_id", "label", "q")
    right = anchors.select(*keys, every(shards).alias("s"), block.alias("b"), "vec_id", "label", "q", "windows").toDF(
        *group, "anchor", "anchor_label", "anchor_q", "windows")
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(
        _search(k, same_label), "anchor_id long, lo long, hi long, vec_id long, score long")
    first = Window.partitionBy("anchor_id", "lo", "hi").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", scale: int = 256, positives: int = 5, negatives: int = 10,
                   low_percent: int = 30, high_percent: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(scale * x). The positives of an anchor (a row
    for which ``is_anchor`` holds) are its first ``positives`` other rows of the
    same label, by inner product downwards, then id. For each of them the first
    ``negatives`` rows of other labels with low * positive <= 100 * negative <=
    high * positive are returned, fewer if there are fewer.

    Rows with a null id or label, a null or empty vector, or a null or non-finite
    component take no part; nor do rows with a component of 2**26 and more after
    scaling, whose products could leave 64 bits. Rows of one id are one row (the
    smallest of label and vector). Vectors meet those of the same length only. An
    empty table gives an empty result; other columns are not read."""
    v = vectors.withColumn("__anchor", is_anchor.cast("boolean")).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("x"), F.coalesce("__anchor", F.lit(False)).alias("anchor"))
    fits = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(F.floor(c * scale)) < LIMIT) & (F.abs(c) < float("inf")))
    v = v.where("vec_id is not null and label is not null and size(x) > 0").where(fits)
    v = v.select("vec_id", "anchor", "label", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("q"))
    v = v.groupBy("vec_id").agg(F.min(F.struct("label", "q", "anchor")).alias("r"))
    v = land(v.select("vec_id", "r.label", "r.q", "r.anchor", F.size("r.q").alias("dim")))

    count = lambda *keys: v.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.count_if("anchor").alias("n_anchors")).where("n_anchors > 0")
    own = count("dim", "label")
    any_score = F.array(F.struct(F.lit(-(1 << 63)).alias("lo"), F.lit((1 << 63) - 1).alias("hi")))
    anchors = v.where("anchor").withColumn("windows", any_score)
    keys = ["dim", "label"]
    best = _best(v.join(own, keys).withColumn("own", F.col("label")), anchors.join(own, keys).withColumn("own", F.col("label")),
                 ["dim", "own"], positives, True)
    best = land(best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    # low * p <= 100 * s <= high * p, for integers
    best = best.withColumn("lo", F.expr(f"({int(low_percent)} * positive_score + 99 - pmod({int(low_percent)} * positive_score + 99, 100)) div 100"))
    best = best.withColumn("hi", F.expr(f"({int(high_percent)} * positive_score - pmod({int(high_percent)} * positive_score, 100)) div 100"))
    windows = best.where("lo <= hi").groupBy("anchor_id").agg(F.collect_set(F.struct("lo", "hi")).alias("windows"))
    total = count("dim")
    anchors = v.where("anchor").join(windows.withColumnRenamed("anchor_id", "vec_id"), "vec_id").join(total, "dim")
    found = _best(v.join(total, "dim"), anchors, ["dim"], negatives, False)
    found = found.select("anchor_id", "lo", "hi", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.join(found, ["anchor_id", "lo", "hi"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
