"""Documents to training tokens: quality, near-duplicates, repeated passages, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
documents. ``run`` writes what each stage returns to the shared folder and reads it back, so a lost executor costs no more
than the stage under way. Empty tables pass through all stages; nulls and repeated rows are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dealweave.llm import decontamination, quality, sentencepiece_codec, simhash_dedup, suffix_dedup
from dealweave.llm.common import scratch, settle, table

#: No SQL says what boosted trees, covering codes and suffix arrays decide; tests hold the stages against brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by the labels of this corpus, accepts."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return simhash_dedup.deduplicate(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without byte strings that occur twice."""
    return suffix_dedup.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of benchmark; one that is little else goes."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids, n_byte_ids and round_trip of each document."""
    return sentencepiece_codec.op5(docs)


STAGES = [
    ("quality classifier", good_quality), ("SimHash near-dedup", one_of_each_group), ("suffix-array dedup", without_repeats), ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = settle(stage(spark, docs, sf_dir), f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
