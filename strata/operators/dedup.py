"""Deduplication with a fixed survivor, and upserts.

``row_number() = 1`` over the business key is planned by Spark as a
partial ``WindowGroupLimit`` before the shuffle and a final one after it,
so a key that holds a large share of the rows is cut down to one row per
map task before anything is exchanged. The price is a sort of every map task;
``dedup_placed`` pays it for such keys only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from strata.schemas import DATASETS


def _ordering(columns: Sequence[str | Column]) -> list[Column]:
    out = []
    for c in columns:
        out.append(c if isinstance(c, Column) else F.col(c).asc_nulls_first())
    return out


def dedup_by_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key; the survivor is the first row by ``order``."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*_ordering(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_dataset(df: DataFrame, dataset: str) -> DataFrame:
    ds = DATASETS[dataset]
    return dedup_by_key(df, ds.key, [c for c in ds.survivor_order if c in df.columns])


def spread_keys(df: DataFrame, key: str, by: str) -> DataFrame:
    """64-bit hashes (``_h``) of the keys whose rows do not share one non-NULL value of ``by``.

    Only hashes and values of ``by`` are shuffled; two keys that share a hash may be listed, too.
    """
    per_key = df.groupBy(F.xxhash64(key).alias("_h")).agg(
        F.min(by).alias("_low"), F.max(by).alias("_high"), F.count(by).alias("_known"), F.count(F.lit(1)).alias("_n")
    )
    return per_key.where((F.col("_low") != F.col("_high")) | (F.col("_known") < F.col("_n"))).select("_h")


def dedup_placed(
    df: DataFrame, dataset: str, by: str | None = None, partitions: int | None = None,
    hot: DataFrame | None = None, spread: DataFrame | None = None,
) -> DataFrame:
    """``dedup_dataset`` of rows that are shuffled once, by ``by`` (default: the key), and sorted only then.

    A partial limit sorts every row before the shuffle, and whole scan tasks rarely fit in memory.
    Here it serves only the rows that one task could not take: those whose ``by`` is NULL or in ``hot``
    (see ``operators.joins.hot_keys``; None: there are none). Where ``by`` is not the key, the rows of the
    :func:`spread_keys` (``spread``; None: there are none) go with them, since they do not meet by ``by``.
    The others end up in ``partitions`` partitions by a hash of ``by``.
    """
    ds = DATASETS[dataset]
    by = by or ds.key
    aside = F.col(by).isNull()
    marked = df
    if hot is not None:
        marked = marked.join(F.broadcast(hot.select(by, F.lit(True).alias("_hot"))), by, "left")
        aside = aside | F.col("_hot").isNotNull()
    if spread is not None:
        listed = spread.select(F.col("_h").alias("_spread"))
        marked = marked.join(listed, F.xxhash64(ds.key) == F.col("_spread"), "left")
        aside = aside | F.col("_spread").isNotNull()
    here, there = (marked.where(c).select(*df.columns) for c in (~aside, aside))
    order = [c for c in ds.survivor_order if c in df.columns]
    placed = here.repartition(by) if partitions is None else here.repartition(partitions, by)
    w = Window.partitionBy(*dict.fromkeys((by, ds.key))).orderBy(*_ordering(order))
    kept = placed.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return kept.unionByName(dedup_by_key(there, ds.key, order))


def upsert(
    base: DataFrame,
    changes: DataFrame,
    key: str,
    version: str,
    delete_flag: str | None = None,
) -> DataFrame:
    """MERGE semantics without a transactional table format.

    The latest row per key (highest ``version``; a change wins over the base
    on ties, and equal changes are ordered by their other columns) replaces
    the older ones; a latest row whose ``delete_flag`` is
    true removes the key. The caller writes the result to a *new* location.
    """
    tagged_base = base.withColumn("_src_rank", F.lit(0))
    tagged_changes = changes.withColumn("_src_rank", F.lit(1))
    if delete_flag is not None and delete_flag not in base.columns:
        tagged_base = tagged_base.withColumn(delete_flag, F.lit(False))
    both = tagged_base.unionByName(tagged_changes, allowMissingColumns=True)
    # remaining (orderable) columns make ties between equal versions deterministic
    rest = [
        F.col(f.name).asc_nulls_first()
        for f in both.schema.fields
        if f.name not in (key, version, "_src_rank") and not isinstance(f.dataType, MapType)
    ]
    latest = dedup_by_key(
        both,
        key,
        [F.col(version).desc_nulls_last(), F.col("_src_rank").desc(), *rest],
    ).drop("_src_rank")
    if delete_flag is not None:
        latest = latest.where(~F.coalesce(F.col(delete_flag), F.lit(False))).drop(delete_flag)
    return latest
