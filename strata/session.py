"""Session helpers: scratch locations and settings the layers rely on.

Nothing here creates a session for library code; the caller passes one in.
``local_session`` exists for tests and the bench script only.
"""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables and stream checkpoints.

    Uses the cluster's ``spark.checkpoint.dir`` (or a directory already set
    with ``setCheckpointDir``). Only a local session, as in tests, may do
    without: it gets a folder under the SQL warehouse, registered as the
    checkpoint dir. Anywhere else a missing setting is an error, because a
    machine-local folder would not be shared.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        root = warehouse.rstrip("/") + "/_strata_checkpoints"
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused directory below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/strata/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def utc(spark: SparkSession):
    """Run a block with the session time zone set to UTC, then restore it.

    Day windows over event time are defined in UTC; the time zone is bound
    when a plan is analyzed and when a stream starts (streams clone the
    session), so the block must cover both.
    """
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "UTC")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and local benchmarking (UI off, AQE on, UTC).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("strata")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
