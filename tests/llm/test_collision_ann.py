"""Collision-counting search: recall and exact scores against brute force."""

import numpy as np
from pyspark.sql import functions as F

from talewright.llm.collision_ann import nearest, search_block
from talewright.llm.queries import op9_collision_ann


def test_recall_and_scores(spark, sf01):
    rows = spark.read.parquet(f"{sf01}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    got: dict = {}
    for r in op9_collision_ann(spark, sf01).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == sorted(ids[ids % 50 == 0].tolist())
    hits = 0
    for q, found in got.items():
        s = unit @ unit[np.flatnonzero(ids == q)[0]]
        s[ids == q] = -9
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        for _, v, score in found:
            assert abs(score - s[np.flatnonzero(ids == v)[0]]) < 1e-12
        assert [-sc for *_, sc in found] == sorted(-sc for *_, sc in found)
        hits += sum(sc >= np.sort(s)[-5] - 1e-12 for *_, sc in found)
    assert hits / (5 * len(got)) >= 0.9


def test_blocks_of_both_sides(spark, sf01):
    v = spark.read.parquet(f"{sf01}/embeddings.parquet")
    whole = nearest(v, F.col("vec_id") % 10 == 0, 3, share=1.0).collect()
    dealt = nearest(v, F.col("vec_id") % 10 == 0, 3, share=1.0, block_vectors=64, block_queries=16).collect()
    key = lambda rows: sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in rows)
    assert key(whole) == key(dealt)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, []), (None, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [-2.0, 0.0]), (100, [0.0, 3.0]), (100, [0.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("dim", F.lit(2))
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in nearest(df, F.col("vec_id") % 50 == 0).collect())
    half = round(0.5 ** 0.5, 9)
    assert got == [(0, 1, 1, half), (0, 2, 2, half), (0, 3, 100, 0.0), (0, 4, 9, -1.0),
                   (100, 1, 1, half), (100, 2, 2, half), (100, 3, 0, 0.0), (100, 4, 9, 0.0)]
    assert nearest(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_complete_search_finds_all():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 16))
    q, v, s = search_block(np.arange(300), x, np.array([7]), x[7:8], 299, share=1.0)
    assert sorted(v.tolist()) == [i for i in range(300) if i != 7]
