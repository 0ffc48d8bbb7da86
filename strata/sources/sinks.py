"""Table sinks. Every write is a full overwrite unless stated otherwise.

The storage format is a parameter (default Parquet). Counts that the
layers report are taken with ``Observation`` during the write itself, so
no second pass over the data is needed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_observed(
    df: DataFrame,
    path: str,
    label: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    extra: dict[str, Column] | None = None,
) -> dict[str, int]:
    """Overwrite ``path`` and return ``rows`` (+ ``extra`` aggregates) from the same job.

    The observation sits directly under the write, i.e. in the job's result
    stage, where Spark counts each task exactly once even if tasks re-run.
    """
    obs = Observation(f"{label}_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")] + [c.alias(k) for k, c in (extra or {}).items()]
    write_table(df.observe(obs, *metrics), path, fmt, partition_by)
    return {k: int(v) if v is not None else 0 for k, v in obs.get.items()}


def append_partition(df: DataFrame, path: str, partition_col: str | list[str], fmt: str = "parquet") -> None:
    """Append one batch to a history table partitioned by ``partition_col`` (one column or several).

    Dynamic partition overwrite: a re-run of the same batch replaces only
    its own partition, older batches stay.
    """
    (
        df.write.mode("overwrite")
        .format(fmt)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .save(path)
    )


def write_bucketed_observed(
    df: DataFrame,
    path: str,
    table: str,
    key: str,
    buckets: int,
    label: str,
    fmt: str = "parquet",
    extra: dict[str, Column] | None = None,
) -> dict[str, int]:
    """Overwrite a catalog table at ``path``, hash-bucketed and sorted on ``key``.

    A task adds a file to every bucket that it has rows of, so the rows should already lie
    in ``buckets`` partitions on ``key`` (``dedup_placed``), but for those of hot
    keys, which many tasks hold. Later joins and aggregations on ``key`` with the same number of partitions read the table
    without another shuffle. Returns ``rows``, observed in the write's result stage.
    """
    obs = Observation(f"{label}_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")] + [c.alias(k) for k, c in (extra or {}).items()]
    writer = df.observe(obs, *metrics).write.mode("overwrite").format(fmt)
    writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return {k: int(v) if v is not None else 0 for k, v in obs.get.items()}


CLUSTER_BITS = 4  # per column: 16 ranges of equal share


def write_clustered(
    df: DataFrame, path: str, by: dict[str, Column], bloom: list[str] | None = None, partitions: int | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Overwrite ``path`` with files that are narrow in every column of ``by`` at once.

    ``by`` maps a column to a number that orders it. Each becomes the index of its range
    (ranges of equal share, from one aggregate), and rows are range-partitioned and sorted
    by the interleaved bits of the indexes, so row groups hold a small rectangle of values
    and Parquet's statistics skip the others. Columns in ``bloom``, which are not in that
    order, get Bloom filters for point lookups. Rows of one rectangle are spread by a hash.
    """
    n = 1 << CLUSTER_BITS
    shares = [i / n for i in range(1, n)]
    limits = df.agg(*[F.percentile_approx(c.cast("double"), shares, 1000).alias(f"c{i}") for i, c in enumerate(by.values())]).first()
    place = F.lit(0)
    for i, c in enumerate(by.values()):
        bounds = limits[i] or []
        index = sum((F.coalesce(c.cast("double") >= F.lit(b), F.lit(False)).cast("int") for b in bounds), F.lit(0))
        for bit in range(CLUSTER_BITS):
            place = place + F.shiftleft(F.shiftright(index, bit).bitwiseAND(F.lit(1)), len(by) * bit + i)
    placed = df.withColumn("_place", place)
    order = ["_place", F.xxhash64(*df.columns)]
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartitionByRange(parts, *order).sortWithinPartitions("_place", *by).drop("_place")
    writer = placed.write.mode("overwrite").options(**(options or {}))
    for c in bloom or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
