import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from strata.operators import drift
from strata.sources.evolution import MappedTable
from strata.sources.sinks import write_clustered


def test_columns_are_found_by_id(spark, scratch):
    t = MappedTable(spark, scratch)
    one = spark.createDataFrame([(1, "a", 1.5)], "n int, s string, f float")
    t.create(one.schema)
    t.append(one, "1")
    t.evolve(rename={"s": "text"}, widen={"n": LongType(), "f": DoubleType()}, order=["f", "text", "n"])
    t.append(spark.createDataFrame([(2**40, "b", 2.5)], "n long, text string, f double"), "2")
    t.evolve(drop=["text"], add={"extra": StringType()})
    t.evolve(add={"text": StringType()})  # the name again, another column
    t.append(spark.createDataFrame([(3, 3.5, "x", "t")], "n long, f double, extra string, text string"), "3")
    got = t.read()
    assert got.columns == ["f", "n", "extra", "text"]
    want = [(1.5, 1, None, None), (2.5, 2**40, None, None), (3.5, 3, "x", "t")]
    assert sorted(map(tuple, got.collect())) == want
    t.append(spark.createDataFrame([(4, 4.5, None, "u")], "n long, f double, extra string, text string"), "3")  # the load again
    assert sorted(r.n for r in t.read().collect()) == [1, 4, 2**40]
    with pytest.raises(ValueError):
        t.evolve(rename={"f": "n"})
    with pytest.raises(ValueError):
        t.append(one, "4")


def exact_distance(earlier, now):
    now, earlier = sorted(now), sorted(earlier)
    deciles = [now[max(0, -(-int(s * 100) * len(now) // 100) - 1)] for s in drift.SHARES]
    return max(abs(sum(x <= q for x in earlier) / len(earlier) - s) for q, s in zip(deciles, drift.SHARES))


def test_drift_is_within_the_sketch_of_the_exact_distance(spark):
    rnd = random.Random(3)
    batches = [[rnd.gauss(0, 1) for _ in range(6000)] for _ in range(3)]
    batches += [[rnd.gauss(0.5, 1) for _ in range(6000)], [rnd.gauss(0, 3) for _ in range(6000)], [None] * 50]
    rows = [(k, v) for k, b in enumerate(batches) for v in b] + [(0, float("nan"))]
    df = spark.createDataFrame(rows, "batch int, v double")
    got = {r.batch: r for r in drift.drift_gate(drift.profile(df, "batch", ["v"]), "batch", 0.1).collect()}
    assert got[0].distance is None and got[0].nulls == 1 and got[5].distance is None and got[5].nulls == 50
    for k in range(1, 5):
        want = exact_distance([v for b in batches[:k] for v in b], batches[k])
        assert abs(got[k].distance - want) < 0.015
    assert [got[k].passed for k in range(6)] == [True, True, True, False, False, True]


def test_repeated_keys(spark):
    rows = [(1, "a"), (1, "b"), (2, "a"), (2, "a"), (2, None), (3, None), (3, "z")]
    got = drift.repeated_keys(spark.createDataFrame(rows, "batch int, k string"), "batch", "k")
    assert sorted(map(tuple, got.collect())) == [(1, 2, 0, True), (2, 3, 2, False), (3, 2, 1, False)]


def scanned_rows(df):
    """Rows that the Parquet scan of ``df`` gave out (row groups and pages skipped are not in it)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_clustered_files_are_skipped_in_both_columns(spark, scratch):
    n = 40_000
    df = spark.range(n).select(
        F.pmod(F.xxhash64("id"), F.lit(5000)).alias("a"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000)).alias("b"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1_000_000)).alias("k"),
    )
    small = {"parquet.block.size": "20000", "parquet.block.size.row.check.min": "100", "parquet.block.size.row.check.max": "500",
             "parquet.enable.dictionary": "false"}
    df.repartition(64).write.options(**small).parquet(f"{scratch}/plain")
    write_clustered(df, f"{scratch}/clustered", {"a": F.col("a"), "b": F.col("b")}, bloom=["k"], partitions=64, options=small)
    plain, clustered = (spark.read.parquet(f"{scratch}/{p}") for p in ("plain", "clustered"))
    assert sorted(clustered.collect()) == sorted(df.collect())
    some = df.first()["k"]
    for condition, share in (("a between 1000 and 1300", 0.4), ("b between 1000 and 1300", 0.4),
                             ("a between 1000 and 1300 and b between 3000 and 3300", 0.2), (f"k = {some}", 0.5)):
        found, reference = clustered.where(condition), plain.where(condition)
        assert sorted(found.collect()) == sorted(reference.collect()) != []
        assert scanned_rows(found) <= share * scanned_rows(reference), condition
