"""Small local inputs: rows given in code, and integer ranges.

These build bounded DataFrames on the driver; they are meant for smoke
checks and reference tables, never for data that grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources.catalog import read_table, save_as_table


def rows_with_schema(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """Rows against an explicit schema; a NULL in a non-nullable field raises."""
    return spark.createDataFrame(list(rows), schema=schema)


def stamped_range(spark: SparkSession, start: int, end: int) -> DataFrame:
    """``id`` in [start, end) with the processing time (a smoke check of the session)."""
    return spark.range(start, end).withColumn("processed_at", F.current_timestamp())


def load_rows_to_table(
    spark: SparkSession, rows: Sequence[tuple], schema: StructType, table: str, fmt: str = "parquet"
) -> DataFrame:
    """Rows -> stamped with load time -> overwrite ``table`` -> read back.

    Fails when the table read back does not hold exactly the given rows' count.
    """
    df = rows_with_schema(spark, rows, schema).withColumn("_ingestion_timestamp", F.current_timestamp())
    save_as_table(df, table, fmt)
    result = read_table(spark, table)
    n = result.count()
    if n != len(rows):
        raise ValueError(f"{table}: expected {len(rows)} rows, found {n}")
    return result
