import os

import pytest
from pyspark.sql import functions as F

from strata.sources.versioned import VersionedTable


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs}


def bucket_files(table, version):
    """Data files per bucket of a version."""
    return {b: sorted(files(f"{table.path}/data/{f}/table_bucket={b}").items()) for b, f in table.manifest(version).items()}


@pytest.fixture()
def table(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t", "id", buckets=16)
    rows = spark.range(400).select("id", F.concat(F.lit("v1-"), "id").alias("value"), F.lit(1).alias("version"))
    assert t.versions() == [] and t.create(rows) == 1
    return t


def test_upsert_rewrites_touched_buckets_only(spark, table):
    before = bucket_files(table, 1)
    changes = spark.createDataFrame(
        [(5, "new five", 2, False), (6, None, 2, True), (1000, "added", 2, False)], "id long, value string, version int, deleted boolean"
    )
    assert table.upsert(changes, "version", "deleted") == 2
    after = bucket_files(table, 2)
    touched = {r[0] for r in changes.select(table._bucket()).distinct().collect()}
    assert {b for b in before if before[b] == after.get(b)} == set(before) - touched and len(touched) <= 3
    assert bucket_files(table, 1) == before  # nothing was overwritten
    new = {r.id: r.value for r in table.read().collect()}
    assert len(new) == 400 and new[5] == "new five" and new[1000] == "added" and 6 not in new and new[7] == "v1-7"
    old = {r.id: r.value for r in table.read(1).collect()}
    assert old == {i: f"v1-{i}" for i in range(400)}
    changed = sorted((r.id, r.value, r._sign) for r in table.changes(1, 2).collect())
    assert changed == [(5, "new five", 1), (5, "v1-5", -1), (6, "v1-6", -1), (1000, "added", 1)]


def test_failed_change_publishes_nothing(spark, table):
    bad = spark.range(3).select("id", F.raise_error(F.lit("boom")).cast("string").alias("value"), F.lit(2).alias("version"))
    with pytest.raises(Exception, match="boom"):
        table.upsert(bad, "version")
    assert table.versions() == [1] and table.read().count() == 400


def test_second_writer_of_a_version_fails(spark, table):
    rows = table._rows(1)
    with pytest.raises(Exception, match="(?i)exist"):
        table._publish(1, [(r.bucket, r.folder, r.rows) for r in rows], table.schema(1))


def test_replace_with_several_rows_per_key_and_null_keys(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/r", "k", buckets=4)
    t.create(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string"))
    t.replace(spark.createDataFrame([(1, "x"), (None, "y"), (None, "y")], "k long, v string"), spark.createDataFrame([(1,), (2,)], "k long"))
    assert sorted(map(str, t.read().collect())) == sorted(map(str, [r for r in spark.createDataFrame([(1, "x"), (None, "y"), (None, "y")], "k long, v string").collect()]))
    assert t.replace(t.read().limit(0), spark.createDataFrame([(1,), (None,)], "k long")) == 3
    assert t.read().collect() == []
    signs = sorted((str(r.k), r.v, r._sign) for r in t.changes(1, 2).collect())
    assert signs == [("1", "a", -1), ("1", "b", -1), ("1", "x", 1), ("2", "c", -1), ("None", "d", -1), ("None", "y", 1), ("None", "y", 1)]


def test_all_rows_deleted_and_added_again(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/e", "k", buckets=4)
    one = spark.createDataFrame([(1, 10)], "k long, n long")
    t.create(one)
    t.add(spark.createDataFrame([(1, -10)], "k long, n long"), ["n"], "n")
    assert t.read().collect() == [] and t.versions() == [1, 2]
    t.add(one, ["n"], "n")
    assert [tuple(r) for r in t.read().collect()] == [(1, 10)]
    with pytest.raises(ValueError, match="no version 9"):
        t.read(9)
