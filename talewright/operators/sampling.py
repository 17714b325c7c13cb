"""Seeded sampling: exact-N sample, draws with replacement, round robin
(SMP1, SMP4-SMP6). All draws hash (seed, key), so a retried task or another
partitioning gives the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from ..functions.hashing import hash_key, uniform
from .ordering import bucket_of, ordered_index

HASH_BUCKET_CHARS = 3  # 16^3 = 4096 buckets on the md5 prefix: uniform, never skewed


def sample_n(
    df: DataFrame, key_cols: Sequence[str], n: int, seed: int, order_cols: Sequence[str] | None = None,
    order_bucket=None, out: str = "sample_rank",
) -> DataFrame:
    """SMP1: exactly ``n`` rows without replacement, seeded. The sample order
    (``md5(seed:key)``, then key) becomes the new record order ``sample_rank``.

    If ``n`` is not below the row count, every row is kept in its original
    order (``order_cols`` / ``order_bucket``, default: the key order).

    The rank is a global index bucketed on the md5 prefix (uniform buckets),
    and buckets past ``n`` are pruned before the bucket-local sort."""
    total = df.count()
    if n >= total:
        oc = list(order_cols or key_cols)
        bucket = order_bucket if order_bucket is not None else _default_bucket(df, oc[0])
        return ordered_index(df, oc, bucket, out=out)
    h = F.md5(hash_key(seed, *key_cols))
    d = df.withColumn("_h", h)
    d = ordered_index(d, ["_h", *key_cols], F.substring("_h", 1, HASH_BUCKET_CHARS), out=out, max_index=n)
    return d.drop("_h")


KEEP_BUCKET = 1024      # key values of a bucket when every row is kept


def _default_bucket(df: DataFrame, first: str):
    if not isinstance(df.schema[first].dataType, (LongType, IntegerType)):
        raise ValueError("order_bucket is needed when the first order column is no integer")
    return bucket_of(first, KEEP_BUCKET)


def draw_indices(spark: SparkSession, batch: int, n: int, seed: int, out: str = "row_idx") -> DataFrame:
    """``batch`` draws with replacement from ``[0, n)``: (draw, row_idx)."""
    d = spark.range(batch).withColumnRenamed("id", "draw")
    return d.withColumn(out, F.floor(uniform(seed, "draw") * F.lit(n)).cast("bigint"))


def record_batch(indexed: DataFrame, split: str, batch: int, seed: int, idx_col: str = "idx", split_col: str = "split") -> DataFrame:
    """SMP5: ``batch`` records drawn with replacement from one split; any split
    name but ``train`` means the test set. ``indexed`` carries a dense 0-based
    ``idx`` per split (``ordered_index``)."""
    want = "train" if split == "train" else "test"
    part = indexed.filter(F.col(split_col) == want)
    n = part.count()
    if n == 0:
        raise ValueError(f"split {want!r} is empty")
    draws = draw_indices(indexed.sparkSession, batch, n, seed)
    # The draw table has ``batch`` rows: a parameter-bounded broadcast.
    return F.broadcast(draws).join(part, draws["row_idx"] == part[idx_col]).drop("row_idx")


def round_robin(rows: DataFrame, idx_col: str, prompts: DataFrame, prompt_idx_col: str, default_prompt: str | None = None) -> DataFrame:
    """SMP6: row ``i`` takes prompt ``i % len(prompts)``; an empty prompt list
    falls back to the single default prompt. ``prompt_idx_col`` is a dense
    0-based index of the prompts."""
    n_prompts = prompts.count()
    if n_prompts == 0:
        if default_prompt is None:
            raise ValueError("no prompts and no default prompt")
        return rows.withColumn("prompt", F.lit(default_prompt))
    keyed = rows.withColumn("_pk", F.pmod(F.col(idx_col), F.lit(n_prompts)))
    return keyed.join(prompts, keyed["_pk"] == prompts[prompt_idx_col]).drop("_pk")
