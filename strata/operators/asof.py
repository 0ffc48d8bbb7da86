"""Validity intervals of a dimension's history, and the as-of join.

``intervals`` turns batches of full or partial loads into one row per version of a key,
valid from the batch that brought it to the one that replaced it.

``asof_join`` gives each fact the version in force at its time. There is no range
condition and so no cross product within a key: both sides are laid in one sequence per
key and time, and the last version before a fact is carried forward by a window. The
sequence of a key is cut into blocks of time. A block is one window partition, and the
version in force at its start comes from a second window over one row per block, so a
key with a third of all facts is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(history: DataFrame, key: str, batch_time: str, columns: Sequence[str], deleted: str | None = None) -> DataFrame:
    """``key``, ``columns``, ``valid_from`` and ``valid_to`` (exclusive; NULL: still valid).

    Batches that repeat the values before them start no new version. A row whose
    ``deleted`` flag is set ends the version before it. Of several rows of a key with one
    batch time the smallest counts. The window is per key and holds one row per batch.
    """
    flag = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    value = F.struct(flag.alias("_gone"), *columns)
    rows = history.select(key, F.col(batch_time).alias("valid_from"), value.alias("_value"))
    rows = rows.groupBy(key, "valid_from").agg(F.min("_value").alias("_value"))
    along = Window.partitionBy(key).orderBy("valid_from")
    changed = rows.withColumn("_before", F.lag("_value").over(along)).where(
        F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("_value"))
    )
    out = changed.withColumn("valid_to", F.lead("valid_from").over(along)).where("not _value._gone")
    return out.select(key, *[F.col(f"_value.{c}").alias(c) for c in columns], "valid_from", "valid_to")


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    time: str,
    valid_from: str,
    columns: Sequence[str],
    block: Column,
    valid_to: str | None = None,
) -> DataFrame:
    """``facts`` with the ``columns`` of the newest version of ``key`` that starts at or before ``time``.

    NULL where no version has started (or the last one has ended, if ``valid_to`` is
    given), and where the key or the time is NULL. ``block`` is a non-decreasing function
    of the column ``_at``, the time of either side (e.g. its month).
    """
    clash = set(columns) & set(facts.columns)
    if clash:
        raise ValueError(f"columns in both sides: {sorted(clash)}")
    carried = [*columns, *([valid_to] if valid_to and valid_to not in columns else [])]
    fact = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    version = F.struct(F.lit(True).alias("_found"), *[F.col(f"`{c}`") for c in carried])
    left = facts.select(F.col(key).alias("_key"), F.col(time).alias("_at"), fact.alias("_fact"), F.lit(1).alias("_side"))
    right = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_at"), version.alias("_version"), F.lit(0).alias("_side")
    )
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_part", F.struct("_key", block.alias("_block")))
    # a version that starts at a fact's time is in force for it: versions come first
    inside = Window.partitionBy("_part").orderBy(F.col("_at").asc_nulls_first(), "_side")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = both.withColumn("_now", F.last("_version", ignorenulls=True).over(upto)).withColumn(
        "_end", F.lead(F.lit(False), 1, True).over(inside)
    )
    earlier = Window.partitionBy("_part._key").orderBy(F.col("_part._block").asc_nulls_first())
    starts = rows.where("_end").select(
        "_part",
        F.last("_now", ignorenulls=True).over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("_start"),
    )
    joined = rows.where("_side = 1").join(starts, "_part")
    known = F.when(F.col("_at").isNotNull(), F.coalesce("_now", "_start"))
    joined = joined.withColumn("_in_force", known)
    if valid_to:
        ended = F.col(f"_in_force.{valid_to}") <= F.col("_at")
        joined = joined.withColumn("_in_force", F.when(~F.coalesce(ended, F.lit(False)), F.col("_in_force")))
    return joined.select(
        *[F.col(f"_fact.`{c}`").alias(c) for c in facts.columns], *[F.col(f"_in_force.`{c}`").alias(c) for c in columns]
    )
