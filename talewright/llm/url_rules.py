"""URL filter: fixed host/path rules, then association rules mined from the
URLs that those rules judge.

A URL is a set of tokens (scheme, host parts, path parts, query names). The
judged URLs with their verdict as one more token are the transactions of Spark's
FP-growth; rules ``tokens -> verdict`` are kept by support and confidence, and
a rule goes if a rule with fewer tokens says the same as surely. A URL
without a fixed verdict meets the mined rules through an inverted index: each
rule is listed under its rarest token only and checked in full there.

No token is left out: those below the support are in no rule, and tokens that
stand in exactly the same judged URLs (the parameters of one tracking template)
are one class to FP-growth. A rule with two tokens of a class goes for the one
with either of them, so a rule of classes is the rules of one token of each, and a
URL has a class if it has any token of it.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import land

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
DEFAULT = "allow"

#: (verdict, rule); a rule is host/path and holds for the host and its subdomains.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host and path. Host: after the first ``://`` up to / ? # or the end,
    A-Z lower-cased; path: then up to ? or # or the end. Both are empty for a
    null URL or one without ``://``."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return urls.withColumn("host", F.translate(host, _UPPER, _LOWER)).withColumn("path", path)


def tokens(url_col: str = "url"):
    """Distinct tokens of a parsed URL."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    labels = F.filter(F.split("host", r"\."), lambda x: x != "")
    n = F.size(labels)
    # top level, and the parts of the host by their distance from it
    hosts = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                        lambda i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), F.coalesce(F.try_element_at(labels, -i), F.lit(""))))
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    parts = F.transform(parts, lambda x, i: F.concat(F.lit("p"), i.cast("string"), F.lit(":"), x))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    scheme = F.array(F.concat(F.lit("s:"), F.substring_index(url, "://", 1)))
    found = F.concat(F.when(F.col("host") != "", F.concat(scheme, hosts)).otherwise(F.array().cast("array<string>")), parts,
                     F.filter(names, lambda x: x != "q:"))
    return F.array_sort(F.array_distinct(found))


def base_rules(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    rows = [(r, r.split("/", 1)[0], "/" + r.split("/", 1)[1], v) for v, r in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, base string")


def token_classes(judged: DataFrame, min_support: float) -> DataFrame:
    """(token, class, n) of the tokens in at least ``min_support`` of the judged
    URLs; tokens of exactly the same URLs share a class, named by the smallest."""
    total = judged.count()
    seen = judged.select(F.explode("tokens").alias("token"), F.xxhash64("row").alias("x"), F.xxhash64(F.lit("y"), "row").alias("y"))
    seen = seen.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    # bounded by the support: min_support of the URLs hold each of them
    seen = land(seen.where(F.col("n") >= min_support * total))
    return seen.join(seen.groupBy("n", "x", "y").agg(F.min("token").alias("class")), ["n", "x", "y"]).select("token", "class", "n")


def mine(judged: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """(tokens, verdict, confidence, support) of the mined rules. ``judged`` has
    tokens and verdict; the verdict is one more item of the transaction."""
    items = judged.select(F.array_append("tokens", F.concat(F.lit("="), F.col("verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent")[0].startswith("=") & ~F.exists("antecedent", lambda t: t.startswith("=")))
    # bounded by the support: a rule holds in min_support of the URLs at least
    rules = land(rules.select(F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], 2, 99).alias("verdict"), "confidence", "support"))
    short = rules.select(F.col("tokens").alias("fewer"), F.col("tokens")[0].alias("token"), F.col("verdict").alias("same"), F.col("confidence").alias("sure"))
    long = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token"))
    more = long.join(short, "token").where(
        (F.col("verdict") == F.col("same")) & (F.col("sure") >= F.col("confidence")) & (F.size("fewer") < F.size("tokens"))
        & (F.size(F.array_except("fewer", "tokens")) == 0))
    return land(rules.join(more.select("tokens", "verdict").distinct(), ["tokens", "verdict"], "left_anti"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", *, rules: list[tuple[str, str]] = RULES,
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per input row: (id, host, path, rule, verdict).

    ``rule`` is the longest fixed rule that fits (ties: the first in order),
    else null. Its verdict stands; otherwise that of the surest mined rule (then
    the most frequent, then the one with more tokens, then block), otherwise
    ``allow``. Null URLs and URLs without ``://`` have an empty host and path
    and are allowed. Null ids and repeated rows stay, row for row. With no
    judged URLs nothing is mined."""
    spark = pages.sparkSession
    d = parse(pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")))
    d = d.withColumn("row", F.monotonically_increasing_id())
    # a fixed rule is listed under its host; a URL looks up every suffix of its own
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, 1_000_000), "."))
    near = d.select("row", "id", "url", "host", "path", F.explode(suffixes).alias("rule_host"))
    near = near.join(base_rules(spark, rules), "rule_host", "left")
    fits = F.col("rule").isNotNull() & F.startswith("path", F.col("rule_path"))
    best = F.min(F.when(fits, F.struct((-F.length("rule")).alias("n"), "rule", "base"))).alias("best")
    known = near.groupBy("row", "id", "url", "host", "path").agg(best)
    known = land(known.select("row", "id", "host", "path", tokens().alias("tokens"), F.col("best.rule").alias("rule"), F.col("best.base").alias("verdict")))
    judged = known.where("verdict is not null")
    if judged.limit(1).count():
        classes = land(token_classes(judged, min_support))
        own = known.select("row", F.explode("tokens").alias("token")).join(F.broadcast(classes), "token")
        own = own.groupBy("row").agg(F.sort_array(F.collect_set("class")).alias("tokens"))
        shared = known.select("row", "verdict").join(own, "row", "left")
        shared = land(shared.select("row", "verdict", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens")))
        open_urls = shared.where("verdict is null")
        mined = mine(shared.where("verdict is not null"), min_support, min_confidence)
        count = classes.select(F.col("class").alias("token"), "n").distinct()
        ids = mined.withColumn("r", F.xxhash64("tokens", "verdict"))
        rare = ids.select("r", F.explode("tokens").alias("token")).join(count, "token").groupBy("r").agg(F.min(F.struct("n", "token")).alias("m"))
        index = ids.join(rare.select("r", F.col("m.token").alias("token")), "r").select(
            "token", F.col("tokens").alias("needed"), F.col("verdict").alias("says"), "confidence", "support")
        met = open_urls.select("row", "tokens", F.explode("tokens").alias("token")).join(index, "token")
        met = met.where(F.size(F.array_except("needed", "tokens")) == 0)
        first = F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), (-F.size("needed")).alias("z"),
                               (F.col("says") != "block").alias("o"), "says")).alias("m")
        said = met.groupBy("row").agg(first).select("row", F.col("m.says").alias("mined"))
        known = known.join(said, "row", "left")
    else:
        known = known.withColumn("mined", F.lit(None).cast("string"))
    verdict = F.coalesce(F.col("verdict"), F.col("mined"), F.lit(DEFAULT))
    return known.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
