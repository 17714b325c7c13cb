"""Story sources: delimited text files and JSON of mixed shape (SRC1-SRC4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_ws

STORY_SEP = "\n\n"


def split_stories(df: DataFrame, col: str = "text", sep: str = STORY_SEP, out: str = "story", pos: str = "pos") -> DataFrame:
    """SRC1 (column form): split ``col`` on ``sep`` left to right, strip every
    piece, drop empty ones. ``pos`` is the piece position before dropping."""
    pieces = F.split(F.col(col), "\\Q" + sep + "\\E")
    d = df.select("*", F.posexplode(pieces).alias(pos, "_piece")).drop(col).withColumn(pos, F.col(pos).cast("bigint"))
    return d.withColumn(out, strip_ws("_piece")).drop("_piece").filter(F.length(F.col(out)) > 0)


def read_pieces(spark: SparkSession, path: str, sep: str = STORY_SEP, suffix: str = ".txt") -> DataFrame:
    """The raw pieces of the text files under ``path`` (names ending in
    ``suffix``): file, split start, position and unstripped ``value``."""
    raw = spark.read.text(path, lineSep=sep, pathGlobFilter=f"*{suffix}")
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )


def read_stories(spark: SparkSession, path: str, sep: str = STORY_SEP, suffix: str = ".txt") -> DataFrame:
    """SRC1 (file form): read text files whose stories are separated by
    ``sep``. One row per story with the file it came from and its position in
    the file (Spark splits each file left to right, like ``str.split``)."""
    d = read_pieces(spark, path, sep, suffix).withColumn("story", strip_ws("value")).drop("value")
    return d.filter(F.length("story") > 0)


def route_split(path: Column | str) -> Column:
    """SRC4: ``train`` if the lower-cased name contains "train", else ``val``
    if it contains "val"; otherwise NULL (the caller drops it)."""
    p = F.lower(F.col(path) if isinstance(path, str) else path)
    return F.when(p.contains("train"), F.lit("train")).when(p.contains("val"), F.lit("val"))


def _object_text(item: Column) -> Column:
    """``text`` if the key exists (even if empty), else ``story``; only
    non-empty JSON strings count. Object text is not stripped."""
    has_text = F.try_variant_get(item, "$.text", "variant").isNotNull()
    t = F.when(has_text, F.try_variant_get(item, "$.text", "variant")).otherwise(
        F.try_variant_get(item, "$.story", "variant")
    )
    is_str = F.schema_of_variant(t) == F.lit("STRING")
    s = F.when(is_str, F.variant_get(t, "$", "string"))
    return F.when(F.length(s) > 0, s)


def json_stories(df: DataFrame, col: str = "json", out: str = "story", pos: str = "item_pos") -> DataFrame:
    """SRC2: polymorphic JSON ingest, decided by value kind (VARIANT), never by
    schema inference.

    A list yields each string item (stripped, non-empty) and each object item;
    an object yields itself; other kinds and unparsable values yield nothing.
    An object gives ``text`` if that key exists, else ``story``; a present
    but empty ``text`` does not fall back."""
    v = F.try_parse_json(F.col(col))
    kind = F.schema_of_variant(v)
    as_list = F.try_variant_get(v, "$", "array<variant>")
    items = F.when(kind.startswith("ARRAY"), as_list).when(kind.startswith("OBJECT"), F.array(v))
    d = df.select("*", F.posexplode(items).alias(pos, "_item")).drop(col).withColumn(pos, F.col(pos).cast("bigint"))
    ikind = F.schema_of_variant(F.col("_item"))
    text = (
        F.when(ikind == "STRING", strip_ws(F.variant_get(F.col("_item"), "$", "string")))
        .when(ikind.startswith("OBJECT"), _object_text(F.col("_item")))
    )
    # A string item only counts inside a list; a top-level object is an item too.
    d = d.withColumn(out, text).drop("_item")
    return d.filter(F.col(out).isNotNull() & (F.length(F.col(out)) > 0))


def whole_json_ok(col: str = "value") -> Column:
    """True when the whole text is exactly one JSON value.

    ``try_parse_json`` reads the first value and ignores what follows, so the
    text must also be the only item of a list and the only value of an object
    written around it: no text that goes on after its first value is both."""
    listed = F.try_parse_json(F.concat(F.lit("["), F.col(col), F.lit("]")))
    valued = F.try_parse_json(F.concat(F.lit('{"k":'), F.col(col), F.lit("}")))
    alone = F.size(F.try_variant_get(listed, "$", "array<variant>")) == 1
    return F.coalesce(F.try_parse_json(F.col(col)).isNotNull() & alone & valued.isNotNull(), F.lit(False))


def read_json_stories(spark: SparkSession, path: str) -> DataFrame:
    """SRC2 (file form): each file is tried as one JSON value; if it is not
    one, each non-blank line is tried and bad lines are skipped."""
    whole = spark.read.text(path, wholetext=True, pathGlobFilter="*.{json,jsonl}").select(
        F.col("_metadata.file_path").alias("file"), F.col("value")
    )
    ok = whole_json_ok("value")
    as_doc = whole.filter(ok).select("file", F.lit(0).cast("bigint").alias("line_no"), F.col("value").alias("json"))
    bad = whole.filter(~ok)
    lines = bad.select("file", F.posexplode(F.split("value", "\n")).alias("line_no", "json")).withColumn(
        "json", strip_ws("json")
    ).filter(F.length("json") > 0).withColumn("line_no", F.col("line_no").cast("bigint"))
    # a line counts only when it is one complete value
    lines = lines.filter(whole_json_ok("json"))
    return json_stories(as_doc.unionByName(lines), "json")


def read_with_fallback(primary: DataFrame, secondary: DataFrame, split_col: str = "split") -> DataFrame:
    """SRC3: rows of ``secondary`` are used only if ``primary`` gave no train
    row. Decided inside the plan (anti join on a one-row probe), no driver
    round trip."""
    probe = primary.filter(F.col(split_col) == "train").select(F.lit(1).alias("_has_train")).limit(1)
    gated = secondary.join(probe, on=F.lit(True), how="left_anti")
    return primary.unionByName(gated)
