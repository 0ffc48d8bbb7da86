"""Window operators that stay balanced when one partition key is huge.

``running_total`` computes ``sum(value) over (partition by p order by o rows
unbounded preceding)`` in two levels: a running sum inside blocks
``(p, block)`` plus, per block, the sum of all earlier blocks of ``p``. A
single key ``p`` with a third of all rows is then spread over its blocks
instead of being sorted in one task; the block-offset window only sees one
row per block.

``top_k`` is ``row_number() <= k``, which Spark plans with a partial
``WindowGroupLimit`` before the shuffle, so each task forwards at most ``k``
rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    value: str,
    block: Column,
    out: str = "running_total",
) -> DataFrame:
    """Running sum per ``partition`` by ``order``; ``block`` must be
    non-decreasing along ``order`` within a partition (e.g. the day of the
    event time), and ties in ``order`` must not cross a block.

    One struct key ``(partition..., block)`` drives the in-block window and the
    join back, and a block's total is its last running sum, so ``df`` is planned
    once: both branches read the same exchange. Struct equality treats NULL
    fields as equal, which keeps NULL partitions whole.
    """
    partition, order = list(partition), list(order)
    rest = [c for c in df.columns if c not in partition]
    key = F.struct(*[F.col(c) for c in partition], block.alias("_block"))
    in_block = Window.partitionBy("_gk").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    running = F.sum(value).over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = (
        df.select(key.alias("_gk"), *rest)
        .withColumn("_inner", running)
        .withColumn("_last", F.lead(F.lit(True), 1, False).over(in_block) == F.lit(False))
    )
    totals = inner.where("_last").select("_gk", F.col("_inner").alias("_block_total"))
    before_w = (
        Window.partitionBy(*[F.col(f"_gk.{c}") for c in partition])
        .orderBy(F.col("_gk._block").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select("_gk", F.sum("_block_total").over(before_w).alias("_offset"))
    total = F.coalesce(F.col("_offset"), F.lit(0)) + F.coalesce(F.col("_inner"), F.lit(0))
    total = F.when(F.col("_offset").isNotNull() | F.col("_inner").isNotNull(), total)
    columns = [F.col(f"_gk.{c}").alias(c) if c in partition else F.col(c) for c in df.columns]
    return inner.join(offsets, "_gk", "inner").select(*columns, total.alias(out))


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows per group by ``order`` (ties broken by ``order`` itself)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
