"""Spark helpers of the llm operators: table scans, landing, components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, table_path


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their
    Python workers can import it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="talewright-code-"), "talewright_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)  # Spark serves the driver's copy to every executor
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def land(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of the cluster
    (``spark.checkpoint.dir``) and read it back: the lineage is cut, later
    scans prune columns, and no executor's loss takes the rows away."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of each batch; one (node, root) edge per node,
    the root being the smallest id."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a < b:
                parent[b] = a
            elif b < a:
                parent[a] = b
        out = [(x, find(x)) for x in list(parent)]
        out = [(x, r) for x, r in out if x != r]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in out], pa.int64()), pa.array([r for _, r in out], pa.int64())], ["u", "v"])


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest id reachable over ``links`` from every
    node that has a link. Union-find inside each batch of links shrinks them to
    a forest; alternating star steps (every node points its larger, then its
    smaller neighbours at its smallest one) join the forests. Each step is an
    aggregate and a join on the node; the lineage is cut after each round."""
    edges = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    edges = land(edges.mapInArrow(_forest, "u long, v long").distinct())
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).where("u <> v")
        new = land(small.distinct())
        depth = new.alias("x").join(new.alias("y"), F.col("x.v") == F.col("y.u"), "left_semi").limit(1).count()
        multi = new.groupBy("u").count().where("count > 1").limit(1).count()
        edges = new
        if not depth and not multi:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))

