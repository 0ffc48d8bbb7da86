import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators.asof import asof_join, intervals

DAY = dt.datetime(2024, 1, 1)


def at(day, hour=0):
    return DAY + dt.timedelta(days=day, hours=hour)


def test_intervals_of_batches(spark):
    rows = [(1, at(0), "a", False), (1, at(1), "a", False), (1, at(2), "b", False), (1, at(2), "c", False), (2, at(1), "x", False),
            (2, at(3), "x", True), (2, at(5), "x", False), (3, at(0), None, False), (3, at(1), "n", False), (None, at(0), "z", False)]
    df = spark.createDataFrame(rows, "id long, t timestamp_ntz, v string, gone boolean")
    got = sorted(map(tuple, intervals(df, "id", "t", ["v"], "gone").collect()), key=str)
    want = [(1, "a", at(0), at(2)), (1, "b", at(2), None), (2, "x", at(1), at(3)), (2, "x", at(5), None),
            (3, None, at(0), at(1)), (3, "n", at(1), None), (None, "z", at(0), None)]
    assert got == sorted(want, key=str)


def brute(facts, versions):
    out = []
    for i, key, when in facts:
        known = [v for v in versions if key is not None and when is not None and v[0] == key and v[1] <= when]
        best = max(known, key=lambda v: v[1], default=None)
        out.append((i, best[2] if best and (best[3] is None or best[3] > when) else None))
    return sorted(out)


def case(n):
    rnd = random.Random(n)
    # key 0 holds most facts; some facts lie before every version, at a version's start, or have no key or time
    facts = [(i, rnd.choice([0] * 6 + [1, 2, 3, None]), rnd.choice([None] + [at(rnd.randint(0, 90), rnd.randint(0, 23))] * 20)) for i in range(n)]
    facts += [(n, 0, at(10)), (n + 1, 9, at(5))]
    versions = []
    for key in range(4):
        days = sorted(rnd.sample(range(2, 85), 6)) + ([10] if key == 0 else [])
        days = sorted(set(days))
        for a, b in zip(days, [*days[1:], None]):
            end = at(b) if b is not None else None
            versions.append((key, at(a), f"{key}-{a}", at(a + 1) if rnd.random() < 0.3 and b is not None else end))
    return facts, versions


def test_asof_join_equals_brute_force(spark):
    facts, versions = case(600)
    f = spark.createDataFrame(facts, "id long, k long, t timestamp_ntz").repartition(5)
    v = spark.createDataFrame(versions, "k long, valid_from timestamp_ntz, v string, valid_to timestamp_ntz")
    for block in (F.date_trunc("week", "_at"), F.to_date("_at"), F.lit(0)):
        got = asof_join(f, v, "k", "t", "valid_from", ["v"], block, "valid_to")
        assert got.columns == ["id", "k", "t", "v"]
        assert sorted((r.id, r.v) for r in got.collect()) == brute(facts, versions)


def test_asof_without_versions_or_facts(spark):
    facts, versions = case(20)
    f = spark.createDataFrame(facts, "id long, k long, t timestamp_ntz")
    v = spark.createDataFrame(versions, "k long, valid_from timestamp_ntz, v string, valid_to timestamp_ntz")
    none = asof_join(f, v.limit(0), "k", "t", "valid_from", ["v"], F.to_date("_at"), "valid_to").collect()
    assert sorted(r.id for r in none) == sorted(i for i, *_ in facts) and {r.v for r in none} == {None}
    assert asof_join(f.limit(0), v, "k", "t", "valid_from", ["v"], F.to_date("_at")).collect() == []


def test_a_hot_key_is_spread_over_tasks_and_no_pairs_are_made(spark):
    n = 5000
    f = spark.range(n).select("id", F.lit(1).alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, cast(id % 2000 as int))").alias("t"))
    v = spark.range(300).select(F.lit(1).alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, cast(id * 6 as int))").alias("valid_from"), F.col("id").alias("v"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = asof_join(f, v, "k", "t", "valid_from", ["v"], F.to_date("_at"))
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(sizes) == 4 and max(sizes) < 0.5 * n and sum(sizes) == n
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
