"""Benchmark sweeps: run grid from comma lists and per-run configuration
(JON2, PRJ8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_int_list(col) -> Column:
    """Comma list -> ints, blank items skipped (``"1337, 42,,7"`` -> [1337, 42, 7])."""
    c = F.col(col) if isinstance(col, str) else col
    items = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.transform(items, lambda x: x.cast("int"))


def sweep_grid(spark: SparkSession, seeds: str, d_models: str, contexts: str) -> DataFrame:
    """JON2: Cartesian product seeds x d_models x contexts; an empty list
    acts as one NULL. Built inside one row with ``explode_outer`` (no join)."""
    row = spark.createDataFrame([(seeds, d_models, contexts)], "seeds string, d_models string, contexts string")
    return sweep_grid_of(row)


def sweep_grid_of(df: DataFrame) -> DataFrame:
    d = df.select("*", F.posexplode_outer(parse_int_list("seeds")).alias("_i", "seed"))
    d = d.select("*", F.posexplode_outer(parse_int_list("d_models")).alias("_j", "d_model"))
    d = d.select("*", F.posexplode_outer(parse_int_list("contexts")).alias("_k", "context_length"))
    order = F.struct(F.coalesce("_i", F.lit(0)), F.coalesce("_j", F.lit(0)), F.coalesce("_k", F.lit(0)))
    return d.withColumn("run_order", order).select("run_order", "seed", "d_model", "context_length")


def apply_overrides(sweep: DataFrame, defaults: dict) -> DataFrame:
    """PRJ8: per run, the override when given, else the default."""
    d = sweep
    for k, v in defaults.items():
        d = d.withColumn(k, F.coalesce(F.col(k), F.lit(v))) if k in sweep.columns else d.withColumn(k, F.lit(v))
    return d
