from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.windows import running_total, top_k


def plain_running(df):
    w = Window.partitionBy("p").orderBy("t", "o").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("running_total", F.sum("v").over(w))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 4), st.integers(-5, 5)), max_size=40))
def test_running_total_matches_window(spark, data):
    df = spark.createDataFrame([(p, t, i, v) for i, (p, t, v) in enumerate(data)], "p int, t int, o int, v int")
    got = running_total(df, ["p"], ["t", "o"], "v", F.col("t"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain_running(df).collect()), key=repr)


def test_top_k_ties_by_order(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 1.0), ("b", 4, 2.0)], "g string, id int, r double")
    out = top_k(df, ["g"], [F.col("r").desc(), F.col("id")], 1)
    assert sorted((r.g, r.id) for r in out.collect()) == [("a", 1), ("b", 4)]


def test_running_total_spreads_one_huge_partition(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # customer 7 has every third of 3000 events (and id 7), spread over 30 days
        df = spark.range(3000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("p"),
            (F.col("id") % 30).alias("t"),
            F.col("id").alias("o"),
            F.lit(1).alias("v"),
        )
        out = running_total(df, ["p"], ["t", "o"], "v", F.col("t"))
        hot = out.where("p = 7")
        assert hot.select(F.spark_partition_id()).distinct().count() > 1  # not one task
        assert hot.agg(F.max("running_total")).first()[0] == 1001  # every third id, plus id 7
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_region_rollup_tells_totals_from_unknown_states(spark):
    from strata.plans.metrics import revenue_by_region

    customers = spark.createDataFrame(
        [(1, "BRAZIL", 10.0, 1), (2, None, 5.0, 1)], "customer_id long, state string, customer_revenue double, order_count long"
    )
    states = spark.createDataFrame([("BRAZIL", "AMERICA")], "state string, region string")
    got = {(r.region, r.state, r.level): r.revenue for r in revenue_by_region(customers, states).collect()}
    assert got[None, None, 3] == 15.0 and got[None, None, 1] == 5.0 and got[None, None, 0] == 5.0
