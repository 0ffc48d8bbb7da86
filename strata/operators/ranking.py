"""A gap-free rank over all rows without a one-task window.

``row_number() over (order by ...)`` moves every row (or every row of a group) to one
task. Here rows are range-partitioned and sorted, which puts them in their final order
across all tasks; a row's rank is then its place in its own partition plus the sizes of
the partitions before it. Only one row per partition and group is summed up in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_path

#: Rows (one per range partition and group) up to which the offsets are broadcast.
BROADCAST_RUNS = 100_000
#: ``monotonically_increasing_id`` keeps the partition number above this many bits.
_PARTITION_SHIFT = 33


def global_rank(
    df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), out: str = "rank", partitions: int | None = None,
    size: str | None = None,
) -> DataFrame:
    """``df`` with its rank (from 1) along ``order`` within ``group`` (all rows if empty),
    and with the number of rows of the group as ``size``, if named.

    ``order`` should be total: rows that tie get different ranks in no fixed order, and
    equal order keys stay in one range partition. NULL group values form one group. The
    sorted rows are written to the shared scratch folder once, so a lost executor cannot
    change a rank that was already given out.
    """
    spark, group = df.sparkSession, list(group)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(c).asc_nulls_first() for c in group], *order]
    path = scratch_path(spark, "ranked")
    placed = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    placed.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn(
        "_run", F.struct(*group, F.shiftright("_at", _PARTITION_SHIFT).alias("_part"))
    )
    runs = rows.groupBy("_run").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*[F.col(f"_run.{c}") for c in group] or [F.lit(0)])
    before = whole.orderBy("_run._part").rowsBetween(Window.unboundedPreceding, -1)
    runs_path = scratch_path(spark, "rank-offsets")
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    runs.select("_run", offset.alias("_shift"), F.sum("_n").over(whole).alias("_size")).write.parquet(runs_path)
    shifts = spark.read.parquet(runs_path)
    if shifts.count() <= BROADCAST_RUNS:
        shifts = F.broadcast(shifts)
    ranked = rows.join(shifts, "_run")
    extra = [F.col("_size").alias(size)] if size else []
    return ranked.select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_at") + F.col("_shift") + 1).alias(out), *extra
    )
