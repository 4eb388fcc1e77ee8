"""The stages of a training corpus, one after another over what the stage before kept.

``quality_classifier`` rejects poor documents, ``simhash_near_duplicates`` keeps one document of each group of near copies,
``decontamination`` removes documents that hold benchmark items, ``secret_scan`` blanks out secrets, and ``packing`` deals the rest
into batches. Each stage reads what the one before wrote. All but the last return the columns of ``documents``; empty tables,
null texts and extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.llm import decontaminate, packing, quality_classifier, secret_scan, simhash
from vaultflow.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; labels of the held-out fold are not learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(docs, labels, quality_classifier.crc("doc_id", 3) != 1)
    return docs.where(quality_classifier.scored(F.col("text"), model) >= 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    An id counts together with its text: texts of one id that are no near copies all stay, rows that repeat both stay once. A
    document without an id comes after all that have one, so it stays only where its whole group has none.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    found = stage(simhash.near_duplicates(docs.select(key.alias("key"), "text"), "key", "text", shingle=4, distance=4), "near_duplicates")
    # rows to keep are few columns; texts move once, by key
    kept = found.where(F.col("key") == F.col("component_id")).select(F.col("key").alias("_kept")).distinct()
    rows = docs.select(key.alias("_key"), F.struct("*").alias("_row"))
    return rows.join(kept, F.col("_key") == F.col("_kept"), "left_semi").dropDuplicates(["_key"]).select("_row.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts blanked out and ``n_chars`` brought up to date."""
    forest = secret_scan.train(secret_scan.silver_findings(docs, path_col="source"), secret_scan.dictionary_of(docs))
    clean = secret_scan.redact(docs, forest, path_col="source")
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document that is left."""
    return packing.pack(docs, packing.n_words(F.col("text")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("simhash_near_duplicates", near_duplicates),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: Models are trained along the way, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
