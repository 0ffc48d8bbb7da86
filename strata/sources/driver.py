"""Reads the driver's Parquet tables.

Callers select only the columns they need right after the read, so the
Parquet scan prunes columns (``ReadSchema``) and receives pushed filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"Unknown driver table: {name}")
    return spark.read.parquet(table_path(sf_dir, name))
