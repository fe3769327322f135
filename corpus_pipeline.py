"""From raw documents to packed token sequences, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, line_quality, phrase_dedup, simhash, window_pack
from strata.llm.common import written
from strata.llm.registry import QUERIES as OPERATOR_QUERIES
from strata.plans.registry import Registered, table


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text that a stage has shortened."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rejected documents, and from the others the lines above the limits."""
    return _counted(line_quality.clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: 4-word shingles, at most 4 differing bits."""
    return simhash.drop_near_duplicates(docs, shingle=4, distance=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document has; a document left without a word goes."""
    kept = phrase_dedup.drop_repeated_phrases(docs, window=13)
    return _counted(kept.filter(F.col("text").rlike("[^\\x20\\x09-\\x0D]")))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a 10-word window of a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"), window=10)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    return window_pack.pack(docs, vocabulary, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

# Fingerprints and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**OPERATOR_QUERIES, "pipeline": Registered("pipeline", run, ORACLE_SQL, ("pipeline",))}
