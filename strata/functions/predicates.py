"""Predicates used by the quality rules.

A rule predicate is true when a row *fails* the rule. ``total`` makes any
predicate two-valued (NULL counts as a failure), so valid and rejected rows
always partition the input exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType


def is_missing(column: str, data_type: DataType) -> Column:
    """NULL, or for text only spaces (``trim`` strips spaces, not tabs)."""
    c = F.col(column)
    if isinstance(data_type, StringType):
        return c.isNull() | (F.trim(c) == F.lit(""))
    return c.isNull()


def total(predicate: Column) -> Column:
    """Three-valued -> two-valued: an unknown outcome fails the rule."""
    return F.coalesce(predicate, F.lit(True))
