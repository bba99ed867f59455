"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import (
    alignment,
    debruijn,
    decontamination,
    disclosure,
    metric_trees,
    minhash,
    ngrams,
    packing,
    quality,
    sharding,
    suffixes,
    toxicity,
    winnowing,
)
from lectern.llm.common import id_and_text, table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return id_and_text(table(spark, folder, "documents"))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity of every document, and whether it is rejected."""
    documents, labels = _documents(spark, folder), table(spark, folder, "labels")
    model = toxicity.fit(documents, toxicity.grade_labels(documents, labels))
    return toxicity.score(documents, model).drop("text")


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return ngrams.score(_documents(spark, folder))


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.compare_with_edits(_documents(spark, folder))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return disclosure.span_digest(disclosure.find_spans(_documents(spark, folder)))


def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, folder), k=2, percent=80).drop("text_key", "component")


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.with_digest(packing.pack(_documents(spark, folder), length=2048))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_texts(_documents(spark, folder), n_shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.without_repeats(_documents(spark, folder), length=100, with_text=False)
    return found.withColumnRenamed("kept", "kept_sha256")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents hold which benchmark items."""
    return decontamination.leaks(_documents(spark, folder), table(spark, folder, "benchmark"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = debruijn.repeated_spans(_documents(spark, folder), k=13, with_text=False)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of two vocabularies share groups of bytes in every document, and how usual its links are."""
    return alignment.align(_documents(spark, folder))


def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    """How likely every document is of good quality, learnt from four fifths of the labels."""
    documents, labels = _documents(spark, folder), table(spark, folder, "labels")
    scored = quality.score(documents, quality.fit(documents, labels), threshold=0.3)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Code and quantisation error of every vector: 16 parts, 64 entries, 2 rounds."""
    return metric_trees.compress(table(spark, folder, "embeddings"), parts=16, entries=64, rounds=2)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_toxicity,
        op2_lm_scoring,
        op3_fingerprints,
        op4_pii,
        op5_minhash,
        op6_packing,
        op7_sharding,
        op8_suffix_dedup,
        op9_decontamination,
        op10_substring_dedup,
        op11_alignment,
        op12_quality,
        op13_vector_codes,
    )
}
