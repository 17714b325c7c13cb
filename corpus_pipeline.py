"""Corpus preparation in five stages; each stage reads what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the
last return the columns of the documents; ``run`` writes each stage's rows as
Parquet into the shared folder and reads them back as the next stage's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talewright.llm import quality
from talewright.llm.bpe import token_digests
from talewright.llm.minhash import near_duplicates
from talewright.llm.qgram_decontam import leaks
from talewright.llm.queries import vocabulary
from talewright.llm.shared import land, ship_code, table
from talewright.llm.suffix_dedup import cut_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; null and empty texts are rejected. The model is
    fitted on the labelled documents of the stage's own input."""
    ship_code(spark)
    model = quality.train(docs, quality.graded(table(spark, sf_dir, "labels")), grades=3)
    return quality.select_documents(docs, model)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group stays (the smallest id; of
    near-duplicate texts of one id the one of the smallest hash). Unlike texts
    of one id are documents of their own. Rows without an id stay; of rows with
    equal id and text one stays (the smallest in the other columns)."""
    ship_code(spark)
    keyed = docs.where("doc_id is not null").withColumn("__key", F.xxhash64("doc_id", "text"))
    near = near_duplicates(keyed, "__key", words=5, percent=80).groupBy("__key").agg(F.min("component_id").alias("__group"))
    ids = keyed.groupBy("__key", "doc_id").agg(F.count("*").alias("__rows")).join(near, "__key")
    ids = land(ids.groupBy("__group").agg(F.min(F.struct("doc_id", "__key", "__rows")).alias("best")).select("best.*"))
    key = ["doc_id", "__key"]
    once = keyed.join(ids.where("__rows = 1").select(*key), key, "left_semi").select(*docs.columns)
    more = keyed.join(ids.where("__rows > 1").select(*key), key, "left_semi")
    more = more.groupBy(*key).agg(F.min(F.struct(*[more[c] for c in docs.columns])).alias("row")).select("row.*")
    return once.unionByName(more).unionByName(docs.where("doc_id is null"))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has are cut out;
    a document of which nothing is left goes."""
    ship_code(spark)
    return cut_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go, row by row."""
    ship_code(spark)
    keyed = docs.withColumn("__key", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    found = leaks(keyed, table(spark, sf_dir, "benchmark"), row_id=F.col("__key"))
    hit = found.select(F.col("row").alias("__key"), "doc_id").distinct()
    # equal text and id: the same verdict for repeated rows and null ids alike
    same = (keyed["__key"] == hit["__key"]) & keyed["doc_id"].eqNullSafe(hit["doc_id"])
    return keyed.join(hit, same, "left_anti").select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text."""
    ship_code(spark)
    return token_digests(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = land(docs)
    return docs


#: A fitted classifier and hashed signatures are beyond SQL; tests/llm holds
#: the pipeline against brute-force versions of its stages.
ORACLE_SQL: str | None = None
