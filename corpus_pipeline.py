"""Corpus pipeline: from raw documents to packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet into the session's shared scratch folder and gives what it rereads to the next
stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import mixing, packing, pii, quality_rules, simhash
from strata.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to the names of its kinds."""
    return pii.redact_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, so that their sources meet the target weights."""
    return mixing.apply_mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences along the Hilbert curve, one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mixing", source_mix),
    ("packing", sequences),
]

#: SQL expresses neither the components, the trained span model, the solver nor the tokenizer;
#: tests/llm/test_pipeline.py compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
