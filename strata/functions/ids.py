"""Batch ids and composed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_BATCH_ID = "batch-0001"


def batch_id_from_time(ts: Column | None = None) -> Column:
    """``yyyyMMdd'T'HHmmss'Z'`` of the load time in UTC, whatever the session time zone."""
    instant = ts if ts is not None else F.current_timestamp()
    # local wall-clock (session zone) -> UTC wall-clock
    return F.date_format(F.convert_timezone(None, F.lit("UTC"), instant), "yyyyMMdd'T'HHmmss'Z'")


def composed_key(*parts: str) -> Column:
    """Text key ``a-b`` from several key columns."""
    return F.concat_ws("-", *[F.col(p).cast("string") for p in parts])


def display_id(prefix: str, key: str, width: int) -> Column:
    """Zero-padded text id, e.g. ``display_id("CUST-", "customer_id", 6)`` -> ``CUST-000042``."""
    return F.format_string(f"{prefix}%0{width}d", F.col(key))


def batch_id_of(wall_clock: str) -> Column:
    """The batch id of a UTC wall-clock time column, whatever the session time zone."""
    return F.date_format(F.col(wall_clock), "yyyyMMdd'T'HHmmss'Z'")
