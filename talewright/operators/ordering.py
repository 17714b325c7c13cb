"""Order-dependent operators without a single-partition window.

Every table carries an explicit order key. Global positions and running sums
are computed as a *two-level prefix sum*:

1. each row gets a bucket (``bucket``: a column expression that is monotone in
   the order and holds a bounded number of rows, e.g. ``floor(doc_id / 4096)``);
2. per (group, bucket) totals are aggregated (partial aggregation, tiny);
3. a window over that small table turns totals into bucket offsets;
4. offsets are joined back and a window *within the bucket* adds the local
   running part.

No window ever spans an unbounded group: a hot source or one giant file is
cut into buckets of bounded size. AQE broadcasts the offsets table when it is
small and falls back to a shuffle join when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from ..functions.text import strip_ws, utf8_prefix

BKT = "_bkt"


def _cols(cs) -> list:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        return [cs]
    return list(cs)


def _names(cs) -> list[str]:
    return [c for c in _cols(cs) if isinstance(c, str)]


def bucket_of(col, width: int) -> Column:
    """Bucket of ``width`` consecutive values of an integral order key."""
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(c / F.lit(width)).cast("bigint")


FANOUT = 1024   # buckets per super-bucket when the bucket offsets are scanned again


def running_agg(
    df: DataFrame,
    value,
    order_cols: Sequence,
    bucket,
    partition_cols: Sequence = (),
    out: str = "running",
    inclusive: bool = True,
    total_col: str | None = None,
    max_offset=None,
    agg: str = "sum",
    levels: int = 2,
    bucket_col: str | None = None,
    _level: int = 0,
) -> DataFrame:
    """Running ``sum`` / ``min`` / ``max`` of ``value`` per partition group in
    ``order_cols`` order (two-level scan, see module doc).

    ``bucket``: Column monotone in the order within a group.
    ``total_col``: also emit the group total (``agg`` over the whole group).
    ``max_offset`` (sum only): drop whole buckets whose offset is
    ``>= max_offset`` before the bucket-local window (early pruning).
    ``levels``: with an integral bucket the per-bucket table is scanned the
    same way again (super-buckets of ``FANOUT`` buckets), so the only window
    without a bounded partition sees ``rows / (width * FANOUT)`` rows.
    ``bucket_col``: also emit the bucket, by which (with the partition group) the
    rows lie together: an aggregate by these and more does not move them again.
    """
    fn = {"sum": F.sum, "min": F.min, "max": F.max}[agg]
    pk = _names(partition_cols)
    bkt, v, tot, off = f"{BKT}{_level}", f"_val{_level}", f"_btot{_level}", f"_boff{_level}"
    val = F.col(value) if isinstance(value, str) else value
    d = df.withColumn(bkt, bucket).withColumn(v, val)

    totals = d.groupBy(*pk, bkt).agg(fn(v).alias(tot))
    wider = _super_bucket(totals.schema[bkt].dataType, bkt)
    if levels > 1 and wider is not None:
        offsets = running_agg(
            totals, tot, [bkt], wider, pk, out=off, inclusive=False,
            total_col=total_col, agg=agg, levels=levels - 1, _level=_level + 1,
        )
        if agg == "sum":
            offsets = offsets.withColumn(off, F.coalesce(F.col(off), F.lit(0)))
    else:
        w_small = Window.partitionBy(*pk).orderBy(bkt)
        prev = fn(tot).over(w_small.rowsBetween(Window.unboundedPreceding, -1))
        offsets = totals.withColumn(off, F.coalesce(prev, F.lit(0)) if agg == "sum" else prev)
        if total_col:
            offsets = offsets.withColumn(total_col, fn(tot).over(Window.partitionBy(*pk)))
    if max_offset is not None:
        offsets = offsets.filter(F.col(off) < F.lit(max_offset))
    offsets = offsets.drop(tot)

    d = d.join(offsets, on=[*pk, bkt], how="inner")
    w = Window.partitionBy(*pk, bkt).orderBy(*_cols(order_cols))
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = fn(v).over(frame)
    if agg == "sum":
        res = F.col(off) + F.coalesce(local, F.lit(0))
    elif agg == "min":
        res = F.least(F.col(off), local)
    else:
        res = F.greatest(F.col(off), local)
    d = d.withColumn(out, res).drop(v, off)
    return d.withColumnRenamed(bkt, bucket_col) if bucket_col else d.drop(bkt)


def _super_bucket(kind, bkt: str):
    """``FANOUT`` neighbouring buckets as one: an integer bucket, or a struct
    such as (file, integer bucket) whose leading fields stay as they are."""
    if isinstance(kind, (LongType, IntegerType)):
        return bucket_of(bkt, FANOUT)
    if isinstance(kind, StructType) and isinstance(kind.fields[-1].dataType, (LongType, IntegerType)):
        *lead, last = [F.col(bkt)[f.name].alias(f"f{i}") for i, f in enumerate(kind.fields)]
        return F.struct(*lead, bucket_of(last, FANOUT).alias("b"))
    return None


def running_sum(df: DataFrame, value, order_cols: Sequence, bucket, partition_cols: Sequence = (), **kw) -> DataFrame:
    """Running sum (two-level scan); see :func:`running_agg`."""
    return running_agg(df, value, order_cols, bucket, partition_cols, agg="sum", **kw)


def ordered_index(
    df: DataFrame,
    order_cols: Sequence,
    bucket,
    partition_cols: Sequence = (),
    out: str = "idx",
    total_col: str | None = None,
    max_index=None,
) -> DataFrame:
    """IX1: 0-based position of each row in ``order_cols`` order (per group).

    The order must be total (ties get an arbitrary but distinct position).
    ``max_index`` keeps only rows with ``idx < max_index`` and prunes whole
    buckets before the bucket-local window.
    """
    d = running_sum(
        df, F.lit(1).cast("bigint"), order_cols, bucket, partition_cols,
        out=out, inclusive=False, total_col=total_col, max_offset=max_index,
    )
    if max_index is not None:
        d = d.filter(F.col(out) < F.lit(max_index))
    return d


def per_source_cap(df: DataFrame, src_col: str, order_cols: Sequence, n: int, out: str = "rank") -> DataFrame:
    """SRC6: keep the first ``n`` rows of every source.

    ``row_number() <= n`` is planned as a window group limit: each map task
    keeps at most ``n`` rows per source before the shuffle, so a hot source
    sends only ``n`` rows per task.
    """
    w = Window.partitionBy(src_col).orderBy(*_cols(order_cols))
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= F.lit(n))


def fill_order_split(
    df: DataFrame, order_cols: Sequence, bucket, n_train: int, n_val: int, split_col: str = "split"
) -> DataFrame:
    """SRC7: global fill in input order: rows ``[0, n_train)`` -> train,
    the next ``n_val`` -> val, the rest is not read (pruned per bucket)."""
    d = ordered_index(df, order_cols, bucket, out="_idx", max_index=n_train + n_val)
    return d.withColumn(
        split_col, F.when(F.col("_idx") < F.lit(n_train), F.lit("train")).otherwise(F.lit("val"))
    ).drop("_idx")


def byte_budget(
    df: DataFrame,
    src_col: str,
    order_cols: Sequence,
    bucket,
    budget_bytes: int,
    text_col: str = "text",
    sep_bytes: int = 2,
    out: str = "text",
) -> DataFrame:
    """SRC5: read only the first ``budget_bytes`` of each source, where a
    source is its stories joined by a ``sep_bytes`` separator. The story that
    crosses the budget is cut (at a character boundary), then stripped;
    empty pieces are dropped."""
    nbytes = F.octet_length(F.col(text_col)) + F.lit(sep_bytes)
    # buckets that begin past the budget are dropped before their texts are shuffled
    d = running_sum(df, nbytes, order_cols, bucket, [src_col], out="_start", inclusive=False, max_offset=budget_bytes)
    d = d.filter(F.col("_start") < F.lit(budget_bytes))
    room = F.lit(budget_bytes) - F.col("_start")
    cut = F.when(F.octet_length(F.col(text_col)) <= room, F.col(text_col)).otherwise(
        utf8_prefix(F.col(text_col), room.cast("int"))
    )
    d = d.withColumn(out, strip_ws(cut)).filter(F.length(F.col(out)) > 0)
    return d.drop("_start")


def ratio_split(
    df: DataFrame,
    order_cols: Sequence,
    bucket,
    train: float = 0.90,
    test: float = 0.05,
    holdout: float = 0.05,
    split_col: str = "split",
) -> DataFrame:
    """SMP2: prefix split by ratios (train / test / holdout_test).

    ``i1 = int(n * train)``; the remainder is cut at
    ``int(rem * (1 - holdout / (test + holdout)))``.
    """
    check_ratios(train, test, holdout)
    keep_frac = 1.0 - holdout / (test + holdout)
    d = ordered_index(df, order_cols, bucket, out="_idx", total_col="_n")
    i1 = F.floor(F.col("_n").cast("double") * F.lit(train))
    i2 = F.floor((F.col("_n") - i1).cast("double") * F.lit(keep_frac))
    return d.withColumn(
        split_col,
        F.when(F.col("_idx") < i1, F.lit("train"))
        .when(F.col("_idx") < i1 + i2, F.lit("test"))
        .otherwise(F.lit("holdout_test")),
    ).drop("_idx", "_n")


def check_ratios(train: float, test: float, holdout: float) -> None:
    """SMP3: ratios must sum to 1 within 1e-6."""
    if abs(train + test + holdout - 1.0) > 1e-6:
        raise ValueError("train/test/holdout ratios must sum to 1.0")
