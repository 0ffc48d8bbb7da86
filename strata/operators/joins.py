"""Skew-aware equi-joins.

A fact table may have one key (a customer, a product) that holds a large
share of all rows; a plain shuffle join sends all of those rows to a single
task. ``skew_join`` splits such hot keys over many tasks, with one plan for
every size of input:

1. ``hot_keys`` finds the keys that hold at least a fair partition's share of
   the rows (rows / shuffle partitions), from a Bernoulli sample of the rows'
   key columns over all files. By that threshold there are at most as many hot
   keys as shuffle partitions, which bounds the broadcast below. Sampling only
   *detects* keys; every row takes part in the join, and a key that is missed
   takes the ordinary path, so the result is exact.
2. Each fact row of a hot key gets a salt in ``[0, n)`` from a hash of the
   row, with ``n`` twice the fair partitions the key fills (at most the
   number of shuffle partitions); the other side's rows of that key are
   repeated once per salt. Other keys get salt 0 on both sides.
3. The join runs on ``(key, salt)``; AQE's skew-join split stays on as a
   second line of defence.

Rows with a NULL key never match, so they are never hot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

SAMPLE_FRACTION = "strata.skew.sampleFraction"  # share of rows read to detect hot keys (default 0.01)
MIN_HITS = 20  # sampled rows below which a key is never called hot


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Table ``keys..., _salts`` of the hot keys of ``df``: at most one row per shuffle partition."""
    conf = df.sparkSession.conf
    partitions = int(conf.get("spark.sql.shuffle.partitions"))
    fraction = float(conf.get(SAMPLE_FRACTION, None) or 0.01)
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    sampled = df.select(*keys).where(not_null)
    if fraction < 1.0:
        sampled = sampled.sample(fraction=fraction, seed=7)
    counts = sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_hits"))
    total = sampled.agg(F.count(F.lit(1))).scalar()
    shares = counts.withColumn("_share", F.col("_hits") * F.lit(partitions) / total)
    salts = F.least(F.lit(partitions), F.greatest(F.lit(2), F.ceil(F.col("_share") * 2)))
    hot = shares.where((F.col("_hits") >= MIN_HITS) & (F.col("_share") >= 1))
    return hot.select(*keys, salts.cast("int").alias("_salts"))


def skew_join(
    fact: DataFrame,
    other: DataFrame,
    keys: str | Sequence[str],
    how: str = "inner",
    hot: DataFrame | Callable[[], DataFrame | None] | None = None,
) -> DataFrame:
    """``fact.join(other, keys, how)`` with hot keys of ``fact`` salted.

    ``how`` is one that keeps the fact side's rows as the driving side:
    inner, left, left_semi or left_anti. ``hot`` is the output of
    :func:`hot_keys` (or a function building it, which gives None where it has
    found that there are none: rows are then joined as they are); pass one computed from the
    *raw* source of ``fact`` (a sampled scan of one column) when ``fact`` is an
    expensive derived plan, so that detection does not recompute it.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"skew_join does not support how={how!r}")
    if callable(hot):
        hot = hot()
        if hot is None:  # looked for, and there are none
            return fact.join(other, keys, how)
    hot = F.broadcast(hot if hot is not None else hot_keys(fact, keys))  # at most one row per shuffle partition
    # any deterministic spread works; maps cannot be hashed, so they are left out
    row_hash = F.xxhash64(*[F.col(f.name) for f in fact.schema.fields if not isinstance(f.dataType, MapType)])
    salted_fact = (
        fact.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod(row_hash, F.col("_salts")).cast("int")),
        )
        .drop("_salts")
    )
    salted_other = (
        other.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(F.col("_salts").isNull(), F.array(F.lit(0))).otherwise(
                    F.sequence(F.lit(0), F.col("_salts") - 1)
                )
            ),
        )
        .drop("_salts")
    )
    return salted_fact.join(salted_other, keys + ["_salt"], how).drop("_salt")
