"""Plan checks: no Python UDF in any registered query, projections and
filters reach the Parquet scan, bounded broadcasts."""

import pytest

from talewright.plans.catalog import QUERIES

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_udf(spark, sf001, key):
    plan = _plan(QUERIES[key](spark, sf001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_column_pruning(spark, sf001):
    plan = _plan(QUERIES["per_source_cap"](spark, sf001))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan


def test_filter_pushdown(spark, sf001):
    from pyspark.sql import functions as F
    from talewright.plans.inputs import read
    df = read(spark, sf001, "conversations").filter(F.col("role") == "assistant").select("conv_id")
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,assistant)]" in _plan(df)


def test_window_group_limit(spark, sf001):
    plan = _plan(QUERIES["per_source_cap"](spark, sf001))
    assert "WindowGroupLimit" in plan


AGG_NODES = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "LocalTableScan", "Range (")


def _first_arg(text: str) -> str:
    depth = 0
    for i, ch in enumerate(text):
        if ch == "(":
            depth += 1
        elif ch == ")":
            if depth == 0:
                return text[:i]
            depth -= 1
        elif ch == "," and depth == 0:
            return text[:i]
    return text


def _unpartitioned(line: str) -> bool:
    """A window spec whose first argument is an ordering or the frame has no
    partition key."""
    k = line.find("windowspecdefinition(")
    if k < 0:
        return False
    first = _first_arg(line[k + len("windowspecdefinition("):]).strip()
    return first.startswith("specifiedwindowframe") or first.endswith(("FIRST", "LAST"))


def _unpartitioned_windows_over_raw_rows(plan: str) -> list[str]:
    """Window nodes with an empty partition spec whose subtree has no
    aggregate (i.e. would run over raw rows in one task)."""
    lines = plan.splitlines()
    bad = []
    for i, line in enumerate(lines):
        if "Window [" not in line or not _unpartitioned(line):
            continue
        indent = len(line) - len(line.lstrip(" :+-"))
        sub = []
        for nxt in lines[i + 1:]:
            if len(nxt) - len(nxt.lstrip(" :+-")) <= indent:
                break
            sub.append(nxt)
        if not any(a in s for s in sub for a in AGG_NODES):
            bad.append(line.strip()[:160])
    return bad


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_global_window_over_raw_rows(spark, sf001, key):
    plan = _plan(QUERIES[key](spark, sf001))
    assert _unpartitioned_windows_over_raw_rows(plan) == []


def test_detector_flags_a_global_window(spark, sf001):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from talewright.plans.inputs import read
    df = read(spark, sf001, "documents").withColumn("rn", F.row_number().over(Window.orderBy("doc_id")))
    assert _unpartitioned_windows_over_raw_rows(_plan(df))


def test_hot_source_is_split_by_bucket(spark):
    """All lines in one source: the line-level window is partitioned by the
    prefix-scan bucket, not by the source alone (no one-task window)."""
    from pyspark.sql import functions as F
    from talewright.operators import blocks, ordering
    lines = spark.range(100000).select(F.lit("one-file").alias("src"), F.col("id").alias("line_no"),
                                       F.when(F.col("id") % 7 == 6, F.lit("<|endoftext|>")).otherwise(F.lit("Story: x")).alias("text"))
    b = blocks.assign_blocks(lines, "src", ["line_no"], ordering.bucket_of("line_no", 1024))
    plan = _plan(b)
    line_windows = [l for l in plan.splitlines() if "Window [" in l and "line_no" in l]
    assert line_windows, plan
    for l in line_windows:
        spec = l[l.index("windowspecdefinition(") + len("windowspecdefinition("):]
        assert _first_arg(spec).startswith("_bkt0"), l      # partitioned by the bucket
    assert _unpartitioned_windows_over_raw_rows(plan) == []
    # and the result is exact: block = number of delimiters before the line
    got = {r.line_no: r.block for r in b.filter(F.col("line_no") < 50).collect()}
    assert got == {i: i // 7 for i in range(50) if i % 7 != 6}
