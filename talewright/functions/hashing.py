"""Seeded, partition-independent randomness: every draw is a hash of
(seed, key), so results are the same under any partitioning, after a task
retry, and in the DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_60 = float(2**60)


def hash_key(seed, *keys) -> Column:
    """String ``"<seed>:<k1>:<k2>..."`` that all draws hash."""
    parts = [seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))]
    for k in keys:
        parts.append(F.lit(":"))
        parts.append((F.col(k) if isinstance(k, str) else k).cast("string"))
    return F.concat(*parts)


def uniform(seed, *keys) -> Column:
    """Uniform double in [0, 1) from the first 60 bits of md5(seed:key...)."""
    h = F.md5(hash_key(seed, *keys))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint").cast("double") / F.lit(TWO_POW_60)


def sql_uniform(seed, *key_sql: str) -> str:
    """DuckDB twin of :func:`uniform` (key expressions given as SQL text)."""
    inner = f"'{seed}'" + "".join(f" || ':' || CAST({k} AS VARCHAR)" for k in key_sql)
    return f"(('0x' || substr(md5({inner}), 1, 15))::BIGINT::DOUBLE / {TWO_POW_60!r})"
