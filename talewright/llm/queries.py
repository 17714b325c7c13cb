"""Registered queries of the training-data operators. Each applies its
operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import token_digests
from . import license_scan as licenses
from . import quality, toxicity
from .collision_ann import nearest
from .grammar_output import token_files
from .hard_negatives import hard_negatives
from .minhash import near_duplicates
from .ngram_join import jaccard_components
from .periodic_runs import periodic_runs, strongest
from .qgram_decontam import leaks
from .shared import table
from .suffix_dedup import repeated_passages
from .twins import ORACLE  # noqa: F401  (the entry reads it here)
from .url_rules import judge


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file (installed on every executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("v")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, quality.graded(table(spark, sf_dir, "labels")), grades=3))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op7_grammar_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 2)


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def op9_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op10_qgram_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Every document whose crc32(doc_id) is divisible by 10 repeats some of its
    words from one of them on (the rule is the query's, fixed by its contract)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    row = F.struct(F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("w"),
                   F.floor(h / 10).alias("g"))

    def repeated(r):
        n = F.size(r["w"])
        a = (r["g"] % n).cast("int")
        p = (F.floor((n - a) / (3 + r["g"] % 8)) + 1).cast("int")
        often = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(r["w"], a + 1, p), often)), 1, n - a)
        return F.array_join(F.concat(F.slice(r["w"], 1, a), tail), " ")

    # the row is bound once, however often the rule names it
    text = F.transform(F.array(row), lambda r: F.when(F.size(r["w"]) > 0, repeated(r)).otherwise(F.lit("")))[0]
    return docs.withColumn("text", F.when((h % 10 == 0) & F.col("text").isNotNull(), text).otherwise(F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    best = found.withColumn("best", strongest(F.col("runs")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_bpe": op3_bpe,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_minhash": op6_minhash,
    "op7_grammar_output": op7_grammar_output,
    "op8_url_rules": op8_url_rules,
    "op9_collision_ann": op9_collision_ann,
    "op10_qgram_decontam": op10_qgram_decontam,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_ngram_join": op13_ngram_join,
}
