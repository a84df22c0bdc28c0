"""The corpus pipeline: quality, line dedup, near-duplicate removal, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet on shared storage and read again as the next one's docs. All but the last return the
columns of ``documents``; a stage's decisions hold for all later ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import decontam, line_dedup, ngram_join, packing, quality
from stratum.llm.common import load, tokenizer_path, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text scores below the cut go."""
    return quality.keep_good(docs, load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay only in the smallest doc_id."""
    return line_dedup.without_repeats(docs)


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest doc_id stays."""
    return ngram_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, also a re-parameterised one, go."""
    return decontam.without_benchmark(docs, load(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, packed into sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

# Stages learn models and use tokenizer files, which SQL cannot express; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
