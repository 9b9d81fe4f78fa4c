"""The training-data pipeline: documents in, packed sequences out.

Each stage is a function of (spark, docs, sf_dir) that works on all rows the stage before it kept.
All but the last return the columns of documents. Stages: documents that the quality classifier
rejects go; repeated chunks of lines go from the texts; of each group of near duplicates the
document of the smallest doc_id stays; repeated passages go from the texts; what is left is packed.

Rows that repeat a doc_id or have none are documents of their own to the near-duplicate stage, a null
doc_id the last to stay. A text of which nothing is left stays as an empty one.

A stage's result runs when it is written, so a stage that is called by itself leaves the session with small
batches for Python; run() puts the session's own setting back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import jaccard, lines, packing, quality, substrings
from starloom.llm.common import quoted, scratch, small_batches, small_batches_from_now, stored, table
from starloom.llm.queries import SEQUENCE_TOKENS, vocabulary

#: Near duplicates share this percentage of their shingles of so many words.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def like_documents(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, n_chars (if there) in keeping with the text."""
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*[quoted(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches_from_now(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return like_documents(lines.without_repeats(docs), docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches_from_now(spark)
    return jaccard.without_near_copies(docs, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches_from_now(spark)
    return like_documents(substrings.without_repeats(docs), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches_from_now(spark)
    return packing.packed(docs, vocabulary(), SEQUENCE_TOKENS)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the classifier, the hashed chunks or the packing; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):
        for k, (name, stage) in enumerate(STAGES):
            docs = stored(stage(spark, docs, sf_dir), folder, f"{k}-{name}")
    return docs
