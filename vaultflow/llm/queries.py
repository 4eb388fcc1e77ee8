"""One query per training-data operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.llm import chunk_dedup, decontaminate, hard_negatives, language_id, packing, paragraph_sketch, quality_classifier, quality_rules, secret_scan, simhash, spelling, token_files, warc_store
from vaultflow.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near copies of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels outside the held-out fold."""
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items, with the item and how much of it."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict; the source stands for the path."""
    docs = table(spark, sf_dir, "documents")
    forest = secret_scan.train(secret_scan.silver_findings(docs, path_col="source"), secret_scan.dictionary_of(docs))
    return secret_scan.findings(docs, forest, path_col="source")


@query
def op3_length_bucket_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document; a token is a word."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, packing.n_words(F.col("text")))


ORACLES["op3_length_bucket_packing"] = packing.oracle()


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, rules and the classifier's verdict for every document."""
    return quality_rules.apply(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive of all pages, written and rebuilt record by record."""
    path = new_folder(spark, "warc")
    warc_store.write(table(spark, sf_dir, "pages"), path)
    return warc_store.described(spark, path)


ORACLES["op8_warc_archive"] = warc_store.ORACLE


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents outside the held-out fold."""
    return language_id.classify(table(spark, sf_dir, "documents"))


@query
def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every later copy of a passage that documents repeat."""
    return chunk_dedup.spans(table(spark, sf_dir, "documents"))


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, found by scanning the token files that hold them."""
    return token_files.counts(table(spark, sf_dir, "documents"), new_folder(spark, "tokens"))


@query
def op11_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how near they are."""
    return paragraph_sketch.next_edits(table(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    vectors = hard_negatives.with_noise(hard_negatives.whole_vectors(table(spark, sf_dir, "embeddings")))
    return hard_negatives.mine(vectors, vectors.where(F.col("id") % 100 == 0))


ORACLES["op12_hard_negatives"] = hard_negatives.ORACLE


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the word that it is most likely a variant of."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))
