"""Corpus pipeline: low quality, exact copies, near copies and contaminated documents go, the rest is packed.

Every stage takes ``(spark, docs, sf_dir)`` and gets the rows that the stage before kept. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardline.llm.exact import drop_exact_copies
from wardline.llm.packing import pack
from wardline.llm.quality import drop_low_quality, fit_quality
from wardline.llm.simhash import drop_near_duplicates
from wardline.llm.wu_manber import drop_contaminated
from wardline.session import store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more; the model is fitted on labelled documents of this stage's input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_low_quality(docs, fit_quality(docs, labels, "quality"), threshold=0.3)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles are linked by three bits or fewer."""
    return drop_near_duplicates(docs, words=3, distance=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), size=2048)


STAGES = [
    ("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
    ("packing", packing),
]
# The classifier's weights cannot be stated in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between them rows are stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
