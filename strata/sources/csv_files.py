"""CSV sources of the raw layer.

``read_source_csv`` is the raw-layer scan: header, PERMISSIVE, an explicit
schema (never inferred), then the three lineage columns. In PERMISSIVE mode
a value that does not parse becomes NULL and the row is kept, so the raw
layer preserves every source row for the quality rules to judge.
``read_strict_csv`` is the enforcing variant: unparsable rows go to a
quarantine side and a header that does not match the schema fails the read.

Event times in the sources are ISO texts, with or without an offset
(``+00:00``); they are parsed as instants (texts without an offset as UTC)
and stored as UTC wall-clock ``timestamp_ntz``, whatever the session zone.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

from strata.schemas import dataset as dataset_spec
from strata.sources.sinks import write_observed

CORRUPT = "_corrupt_record"


def _reading_schema(schema: StructType) -> StructType:
    """Event times are read as instants, so ISO texts with an offset parse."""
    return StructType(
        [
            StructField(f.name, TimestampType(), f.nullable, f.metadata)
            if isinstance(f.dataType, TimestampNTZType)
            else f
            for f in schema.fields
        ]
    )


def _as_utc_wall_clock(df: DataFrame, schema: StructType) -> DataFrame:
    """Instants back to the schema's ``timestamp_ntz`` columns, as UTC wall-clock
    time (independent of the session time zone)."""
    cols = [
        F.convert_timezone(None, F.lit("UTC"), F.col(c)).alias(c)
        if c in {f.name for f in schema.fields if isinstance(f.dataType, TimestampNTZType)}
        else F.col(c)
        for c in df.columns
    ]
    return df.select(*cols)


def _reader(spark: SparkSession):
    # texts without an offset are UTC times, as in the sources
    return spark.read.option("header", True).option("mode", "PERMISSIVE").option("timeZone", "UTC")


def read_source_csv(spark: SparkSession, source_path: str, schema: StructType, batch_id: str) -> DataFrame:
    df = _as_utc_wall_clock(_reader(spark).schema(_reading_schema(schema)).csv(source_path), schema)
    return df.withColumns(
        {
            "_ingestion_timestamp": F.current_timestamp(),
            "_source_file": F.input_file_name(),
            "_batch_id": F.lit(batch_id),
        }
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Header row; values written as they are (no whitespace trimming). An empty source is an
    error, found by the write's own count."""
    obs = Observation(f"csv_{uuid.uuid4().hex[:8]}")
    (
        df.observe(obs, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    if not obs.get["rows"]:
        raise ValueError("a CSV source needs at least one row")


def ingest_dataset(
    spark: SparkSession,
    dataset_name: str,
    source_dir: str,
    raw_dir: str,
    batch_id: str,
    fmt: str = "parquet",
) -> int:
    """Source CSV ``<source_dir>/<name>.csv`` -> raw table ``<raw_dir>/<name>``.

    Returns the row count, measured by an Observation during the write (one
    pass over the source). Works on any Hadoop file system.
    """
    spec = dataset_spec(dataset_name)  # ValueError for an unknown name
    source_path = f"{source_dir.rstrip('/')}/{dataset_name}.csv"
    try:
        df = read_source_csv(spark, source_path, spec.source_schema, batch_id)
    except AnalysisException as exc:
        raise FileNotFoundError(f"no CSV source at {source_path}") from exc
    counts = write_observed(df, f"{raw_dir.rstrip('/')}/{dataset_name}", f"ingest_{dataset_name}", fmt=fmt)
    return counts["rows"]


def ingest_all_datasets(
    spark: SparkSession, source_dir: str, raw_dir: str, batch_id: str, fmt: str = "parquet"
) -> dict[str, int]:
    """All six tables in schema-map order; the first failure stops the run."""
    from strata.schemas import DATASETS

    return {n: ingest_dataset(spark, n, source_dir, raw_dir, batch_id, fmt) for n in DATASETS}


def _strict_reader(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    with_corrupt = StructType(_reading_schema(schema).fields + [StructField(CORRUPT, StringType())])
    df = (
        _reader(spark)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(with_corrupt)
        .csv(path)
    )
    return _as_utc_wall_clock(df, schema)


def read_strict_csv(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with the raw line in ``_corrupt_record``).

    ``enforceSchema=false`` checks the header against the schema, so a file
    whose columns moved fails instead of loading shifted values. Spark refuses
    queries that read *only* ``_corrupt_record`` from a raw file (e.g. a bare
    ``count()`` of the quarantined side); :func:`strict_ingest` writes both
    sides in one pass instead.
    """
    df = _strict_reader(spark, path, schema)
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    quarantined = df.where(F.col(CORRUPT).isNotNull())
    return good, quarantined


def strict_ingest(spark: SparkSession, source_path: str, schema: StructType, out_path: str) -> dict[str, int]:
    """Parse once, write loaded and quarantined rows in one pass.

    Output: ``<out_path>/load_status=loaded`` and
    ``<out_path>/load_status=quarantined`` (the latter keeps the raw line in
    ``_corrupt_record``). Returns both row counts, observed during the write.
    """
    df = _strict_reader(spark, source_path, schema)
    status = F.when(F.col(CORRUPT).isNull(), F.lit("loaded")).otherwise(F.lit("quarantined"))
    counts = write_observed(
        df.withColumn("load_status", status),
        out_path,
        "strict_ingest",
        partition_by=["load_status"],
        extra={"quarantined": F.count_if(F.col(CORRUPT).isNotNull())},
    )
    return {"loaded": counts["rows"] - counts["quarantined"], "quarantined": counts["quarantined"]}
