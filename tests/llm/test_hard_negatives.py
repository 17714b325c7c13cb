"""Hard negatives against brute force, and the odd cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from talewright.llm import hard_negatives as hn
from talewright.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, q string, s int, lo int, own string, dim string, windows int"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "q", 1, 2, "o", "d", 3) for r in rows], SCHEMA).repartition(partitions)


def brute(rows, every, k=5, m=10, low=30, high=90):
    known = {}
    for i, x, label in rows:
        if i is None or label is None or not x or any(c is None or not math.isfinite(c) for c in x):
            continue
        q = [math.floor(256 * c) for c in x]
        if max(map(abs, q)) < hn.LIMIT:
            known[i] = min(known.get(i, (label, q)), (label, q))
    out = set()
    for a, (label, q) in known.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(q, p)) for i, (_, p) in known.items() if len(p) == len(q)}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if known[i][0] == label and i != a][:k]:
            fit = [i for i in ranked if known[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]]
            out |= {(a, p, r, i, score[p], score[i]) for r, i in enumerate(fit[:m], 1)}
    return out


def vectors(seed, n, dim, labels, spread):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, dim))
    label = rng.integers(0, labels, n)
    x = centres[label] * spread + rng.standard_normal((n, dim))
    return [(int(i), [float(c) for c in x[i]], int(label[i])) for i in range(n)]


@pytest.mark.parametrize("dim,labels,spread", [(2, 3, 0.2), (8, 4, 1.0), (32, 10, 0.5), (3, 1, 1.0)])
def test_equals_brute_force(spark, monkeypatch, dim, labels, spread):
    monkeypatch.setattr(hn, "SHARD_ROWS", 97)
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 5)
    rows = vectors(dim, 700, dim, labels, spread)
    got = [tuple(r) for r in hard_negatives(frame(spark, rows), F.col("vec_id") % 25 == 0).collect()]
    assert len(set(got)) == len(got) and set(got) == brute(rows, 25)


def test_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.integers(-2, 3, 4)], int(rng.integers(0, 3))) for i in range(400)]
    got = {tuple(r) for r in hard_negatives(frame(spark, rows), F.col("vec_id") % 20 == 0, scale=256).collect()}
    assert got == brute(rows, 20)


def test_threshold_stops_early():
    rng = np.random.default_rng(5)
    rows = rng.integers(-50, 50, (3000, 2))
    shard = hn.Shard(np.arange(3000), np.zeros(3000, int), rows)
    scored = []
    (at, score), = shard.best(np.array([40, -30]), lambda p: scored.append(len(p)) or np.ones(len(p), bool), [(-10**9, 10**9)], 5)
    exact = rows @ np.array([40, -30])
    expected = sorted(range(3000), key=lambda i: (-exact[i], i))[:5]
    assert at.tolist() == expected and score.tolist() == exact[expected].tolist()
    assert sum(scored) < 1500                      # most rows are never scored


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.1], 2), (3, [0.5, 0.1], 2), (None, [0.5, 0.1], 2),
            (4, None, 2), (5, [], 2), (6, [nan, 1.0], 2), (7, [None, 1.0], 2), (8, [inf, 1.0], 2), (9, [0.5, 0.1], None),
            (10, [0.5], 2), (11, [1e300, 1.0], 2), (12, [0.9, 0.0], 2), (12, [0.4, 0.0], 2), (100, [0.0, 0.0], 2), (200, [-1.0], 3)]
    got = {tuple(r) for r in hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0).collect()}
    assert got == brute(rows, 100) and {r[3] for r in got if r[0] == 0} == {2, 3, 12}
    assert hard_negatives(frame(spark, rows).limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert hard_negatives(frame(spark, rows).where("vec_id = 2"), F.col("vec_id") % 100 == 0).collect() == []
