"""Catalog tables and session identity (metastore or in-memory catalog)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def save_as_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Overwrite a catalog table; for file tables the schema is replaced too."""
    df.write.mode("overwrite").format(fmt).saveAsTable(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def list_schemas(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW SCHEMAS IN {catalog}" if catalog else "SHOW SCHEMAS")


def current_location(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT current_catalog() AS current_catalog, current_schema() AS current_schema")


def session_info(spark: SparkSession) -> DataFrame:
    """One row: current user, catalog and schema, and the number of visible schemas."""
    n_schemas = len(spark.catalog.listDatabases())
    return spark.sql(
        f"SELECT current_user() AS user, current_catalog() AS catalog, current_schema() AS schema, "
        f"{n_schemas} AS schemas"
    )


def show(df: DataFrame, n: int = 20, order_by: str | None = None) -> None:
    """Print rows for a person to look at (sorted when ``order_by`` is given)."""
    (df.orderBy(order_by) if order_by else df).show(n, truncate=False)
