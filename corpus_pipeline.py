"""A corpus pipeline: from raw documents to packed training sequences.

Each stage works on all that its predecessor kept, written as Parquet and read again. All
stages read whole texts of any length, count a null text as empty, treat rows that repeat as rows
of their own unless they say otherwise, and give an empty result for an empty table; all but the
last keep the columns of their input, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pulseframe.llm import exact_dedup, mixing, near_dedup, packing, quality
from pulseframe.llm.common import prepared, saved, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what importance resampling against the labelled target text rejects; equal texts weigh the same."""
    prepared(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group with equal text, the one with the smallest doc_id; all empty texts are one group."""
    prepared(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component (three-word shingles, two bits), the one with the smallest doc_id.

    Texts without words are linked to each other; rows that share a doc_id stay or go together.
    """
    prepared(spark)
    return near_dedup.drop_near_duplicates(docs, shingle=3, bits=2)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or thins documents so that sources reach their target weights; a null source is a source.

    A document's draw depends on its doc_id, so rows that share one share the draw.
    """
    prepared(spark)
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mixture into sequences of 2048 tokens, one row per piece; an empty text is its closing token alone."""
    prepared(spark)
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, length=2048,
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_deduplication", exact_deduplication),
    ("near_deduplication", near_deduplication),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Fingerprints, n-gram models and token ids are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
