import random

from pyspark.sql import functions as F

from strata.operators import ranking
from strata.operators.ranking import global_rank


def rows(n, groups):
    rnd = random.Random(5)
    # the first group holds most rows; None is a group too
    return [(rnd.choice([groups[0]] * 5 + groups), i, rnd.randint(0, 50)) for i in range(n)]


def test_rank_of_all_rows_is_gap_free(spark):
    data = rows(2000, ["a", None])
    df = spark.createDataFrame(data, "g string, id long, v int")
    got = global_rank(df, [F.desc("v"), F.asc("id")], partitions=7).collect()
    want = {i: k + 1 for k, (_, i, _) in enumerate(sorted(data, key=lambda r: (-r[2], r[1])))}
    assert {r.id: r["rank"] for r in got} == want


def test_rank_within_groups(spark, monkeypatch):
    data = rows(1500, ["a", "b", None])
    df = spark.createDataFrame(data, "g string, id long, v int")
    want = {}
    for g in ("a", "b", None):
        inside = sorted((r for r in data if r[0] == g), key=lambda r: (r[2], r[1]))
        want |= {i: k + 1 for k, (_, i, _) in enumerate(inside)}
    for limit in (ranking.BROADCAST_RUNS, 0):  # both ways to bring the offsets back
        monkeypatch.setattr(ranking, "BROADCAST_RUNS", limit)
        got = global_rank(df, [F.asc("v"), F.asc("id")], ["g"], "place", partitions=5)
        assert got.columns == ["g", "id", "v", "place"]
        assert {r.id: r.place for r in got.collect()} == want
    sized = global_rank(df, [F.asc("v"), F.asc("id")], ["g"], size="members").collect()
    assert {(r.g, r.members) for r in sized} == {(g, sum(x[0] == g for x in data)) for g in ("a", "b", None)}


def test_rank_of_no_rows_and_of_equal_rows(spark):
    df = spark.createDataFrame([], "g string, v int")
    assert global_rank(df, [F.asc("v")]).collect() == []
    same = spark.createDataFrame([("x", 1)] * 40, "g string, v int")
    assert sorted(r["rank"] for r in global_rank(same, [F.asc("v")], ["g"]).collect()) == list(range(1, 41))


def test_no_exchange_gathers_all_rows(spark):
    df = spark.createDataFrame(rows(500, ["a", None]), "g string, id long, v int")
    plan = global_rank(df, [F.desc("v"), F.asc("id")], partitions=6)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
