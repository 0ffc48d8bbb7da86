"""Validated layer: quality split, then dedup of the valid side.

Rejected rows are kept whole (not deduplicated). Tables without rules only
go through dedup. Lineage columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from strata.functions.ids import DEFAULT_BATCH_ID
from strata.operators.dedup import dedup_dataset
from strata.operators.joins import hot_keys
from strata.operators.quality import split_by_quality
from strata.schemas import DATASETS
from strata.sources.adapter import raw_table

T = TypeVar("T")


def validate(raw: DataFrame, dataset: str) -> tuple[DataFrame, DataFrame]:
    """(valid and deduplicated, rejected with reason)."""
    valid, rejected = split_by_quality(raw, dataset)
    return dedup_dataset(valid, dataset), rejected


class Silver:
    """Lazily built validated tables of one driver directory.

    Each table (and anything registered with :meth:`cached`) is built once
    per instance, so a query that uses a table twice hands Spark the same
    plan object both times.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, batch_id: str = DEFAULT_BATCH_ID):
        self.spark, self.sf_dir, self.batch_id = spark, sf_dir, batch_id
        self._memo: dict[str, object] = {}

    def cached(self, key: str, build: Callable[[], T]) -> T:
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]  # type: ignore[return-value]

    def raw(self, dataset: str) -> DataFrame:
        return self.cached(f"raw:{dataset}", lambda: raw_table(self.spark, self.sf_dir, dataset, self.batch_id))

    def split(self, dataset: str) -> tuple[DataFrame, DataFrame]:
        return self.cached(f"split:{dataset}", lambda: validate(self.raw(dataset), dataset))

    def rejected(self, dataset: str) -> DataFrame:
        return self.split(dataset)[1]

    def __getattr__(self, dataset: str) -> DataFrame:
        if dataset.startswith("_"):
            raise AttributeError(dataset)
        return self.split(dataset)[0]

    def hot(self, dataset: str, key: str) -> Callable[[], DataFrame]:
        """Builds, when called, the hot values of ``key`` from a row sample of the raw column."""

        def build() -> DataFrame:
            return hot_keys(self.raw(dataset).select(key), [key])

        return lambda: self.cached(f"hot:{dataset}:{key}", build)

    def mart_hot_keys(self) -> dict[str, Callable[[], DataFrame]]:
        """Hot customers (in orders) and hot orders (in order lines) for the marts."""
        return {"customer_id": self.hot("orders", "customer_id"), "order_id": self.hot("order_items", "order_id")}
