import pytest

from strata.plans import layers
from strata.session import scratch_path, scratch_root, utc


def test_scratch_paths_are_fresh_and_under_the_root(spark):
    root = scratch_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)
    if spark.conf.get("spark.checkpoint.dir", None):
        assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_utc_block_restores_the_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with utc(spark):
            assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        with pytest.raises(ValueError):
            with utc(spark):
                raise ValueError("boom")
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bucket_count_bounds(spark):
    assert layers.bucket_count(spark, 0) == spark.sparkContext.defaultParallelism
    rows = 10**12  # not capped by the shuffle partitions
    assert layers.bucket_count(spark, rows) * layers.BUCKET_BYTES >= rows * layers.ROW_BYTES


def test_concurrently_keeps_order_and_raises():
    assert list(layers.concurrently({"b": lambda: 2, "a": lambda: 1})) == ["b", "a"]

    def fail():
        raise RuntimeError("job failed")

    with pytest.raises(RuntimeError, match="job failed"):
        layers.concurrently({"ok": lambda: 1, "bad": fail})
