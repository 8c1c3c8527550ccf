"""Corpus pipeline: each stage applies one operator to what its predecessor kept.

Stages take and (all but the last) return the columns of ``documents``; each
stage's rows are written as Parquet to the shared checkpoint folder and read
again, so a stage never recomputes the ones before it.

A document is rejected only for want of a letter (no language), as a copy, or
as a near copy of a document that stays.  Mixing drops none: it repeats
documents of small sources until the weights are met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from purchlake.llm import content_sort_dedup, genetic_packing, language_bits, ngram_join, temperature_mixing
from purchlake.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language."""
    return language_bits.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id."""
    return content_sort_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id."""
    return ngram_join.keep_one_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources more than once."""
    return temperature_mixing.mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 2048 tokens."""
    return genetic_packing.pack(genetic_packing.pieces(docs))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing to target weights", mixing),
    ("best-fit packing", packing),
]

#: Packing has no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
