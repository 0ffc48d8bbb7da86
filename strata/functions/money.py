"""Exact money arithmetic shared by every layer.

Amounts are summed as ``decimal`` and only the final projection casts to
``double``; doubles would make sums depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.schemas import MONEY


def line_amount(extended_price: str, discount: str) -> Column:
    """price (2 places) * (1 - discount (2 places)), exact at 4 places."""
    price = F.col(extended_price).cast("decimal(12,2)")
    disc = F.col(discount).cast("decimal(4,2)")
    return (price * (F.lit(1) - disc)).cast(MONEY)


def safe_ratio(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    """numerator / denominator as double; ``default`` (or NULL) when the denominator is 0."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))  # NULL on a zero divisor
    return F.coalesce(ratio, F.lit(default).cast("double")) if default is not None else ratio
