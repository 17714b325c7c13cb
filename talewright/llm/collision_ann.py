"""Approximate nearest neighbours by collision counting.

Every projection is one sorted array of the vectors' projections. A query opens
a window around its own projection in each of them; a vector inside the window
collides with the query there. Windows grow by a factor per round (virtual
rehashing: the arrays stay, only the window bounds move outwards), and a vector
whose collisions reach a threshold is verified by its exact cosine. A search
ends when a fixed share of the vectors is verified or all windows are complete.

The vectors are dealt into blocks of bounded size, the queries likewise; a task
searches one block of vectors for one block of queries, and the best of all
blocks are merged per query. The arrays hold every vector.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 64
THRESHOLD = 0.75         # share of the projections in which a candidate collides
VERIFIED = 0.15          # share of a block's vectors verified before a search ends
START = 0.6              # first half width, in standard deviations of the projections
GROW = 1.3
BLOCK_VECTORS = 4096
BLOCK_QUERIES = 1024


def search_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int,
                 projections: int = PROJECTIONS, threshold: float = THRESHOLD, share: float = VERIFIED
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, cosine) of up to ``k`` verified neighbours of every
    query, the query's own row left out."""
    n, dim = x.shape
    norm = np.sqrt((x * x).sum(axis=1))
    unit = x / norm[:, None]
    qnorm = np.sqrt((q * q).sum(axis=1))
    qunit = q / qnorm[:, None]
    axes = np.random.default_rng(20240229).standard_normal((dim, projections))
    proj, qproj = unit @ axes, qunit @ axes
    order = np.argsort(proj, axis=0, kind="stable").T.copy()
    arrays = np.take_along_axis(proj.T, order, axis=1)
    need = max(1, math.ceil(threshold * projections))
    enough = min(n, k + 1 + math.ceil(share * n))
    width = START * max(float(proj.std()), 1e-12)
    rows = np.arange(len(q))
    lo = np.empty((projections, len(q)), np.int64)
    for j in range(projections):
        lo[j] = np.searchsorted(arrays[j], qproj[:, j])
    hi = lo.copy()
    count = [np.zeros(n, np.int16) for _ in rows]
    active = list(rows)
    done: dict[int, np.ndarray] = {}
    while active:
        a = np.array(active)
        nlo, nhi = np.empty((projections, len(a)), np.int64), np.empty((projections, len(a)), np.int64)
        for j in range(projections):
            nlo[j] = np.searchsorted(arrays[j], qproj[a, j] - width)
            nhi[j] = np.searchsorted(arrays[j], qproj[a, j] + width, side="right")
        nlo, nhi = np.minimum(nlo, lo[:, a]), np.maximum(nhi, hi[:, a])
        still = []
        for c, i in enumerate(active):
            parts = [order[j, nlo[j, c]:lo[j, i]] for j in range(projections)]
            parts += [order[j, hi[j, i]:nhi[j, c]] for j in range(projections)]
            count[i] += np.bincount(np.concatenate(parts), minlength=n).astype(np.int16)
            lo[:, i], hi[:, i] = nlo[:, c], nhi[:, c]
            found = np.flatnonzero(count[i] >= need)
            if len(found) >= enough or (hi[:, i] - lo[:, i] == n).all():
                done[i] = found
            else:
                still.append(i)
        active = still
        width *= GROW
    out_q, out_v, out_s = [], [], []
    for i in rows:
        f = done[i]
        f = f[ids[f] != query_ids[i]]
        s = (x[f] @ q[i]) / (norm[f] * qnorm[i])
        best = np.lexsort((ids[f], -s))[:k]
        out_q.append(np.full(len(best), query_ids[i]))
        out_v.append(ids[f][best])
        out_s.append(s[best])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _search(k: int, settings: dict) -> Callable:
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return schema.empty_table()
        got = search_block(vectors["vec_id"].to_numpy(), _matrix(vectors["v"]),
                           queries["vec_id"].to_numpy(), _matrix(queries["v"]), k, **settings)
        return pa.Table.from_arrays([pa.array(got[0], pa.int64()), pa.array(got[1], pa.int64()), pa.array(got[2], pa.float64())], schema=schema)
    return run


def nearest(vectors: DataFrame, is_query, k: int = 5, *, id_col: str = "vec_id", vector_col: str = "embedding",
            block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES, **settings) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row for
    which ``is_query`` holds, by cosine in double precision, ties to the smaller
    id; all candidates if there are fewer.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows
    with a null id take no part. Rows of one id are one vector (the smallest of
    them). Vectors are only compared with those of the same length. An empty
    table gives an empty result."""
    v = vectors.withColumn("is_query", is_query.cast("boolean")).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), "is_query")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda c: c != 0))
    v = v.groupBy("vec_id").agg(F.min(F.struct("v", "is_query")).alias("s")).select("vec_id", "s.v", "s.is_query", F.size("s.v").alias("dim"))
    total = v.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    vb, qb = max(1, math.ceil(total["n"] / block_vectors)), max(1, math.ceil(total["q"] / block_queries))
    deal = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    # each block of vectors meets each block of queries once
    left = v.select("dim", deal(vb, 1).alias("vb"), F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("qb"), "vec_id", "v")
    right = v.where("is_query").select("dim", F.explode(F.sequence(F.lit(0), F.lit(vb - 1))).alias("vb"), deal(qb, 2).alias("qb"), "vec_id", "v")
    keys = ["dim", "vb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k, settings), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
