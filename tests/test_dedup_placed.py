import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators.dedup import dedup_dataset, dedup_placed, spread_keys
from strata.plans import gold, layers

LINE = "order_item_id string, order_id long, product_id long, quantity int, supplier_id long, note string"


@pytest.fixture()
def lines(spark):
    """Lines that stand several times, without a key or an order, with one key in several orders, and of a hot order."""
    rnd = random.Random(4)
    rows = [(f"{i}-{k}", i, rnd.randint(0, 3), rnd.choice([1, None]), 5, "a") for i in range(200) for k in (0, 0, 1)]
    rows += [("moves", rnd.choice([1, 2, None]), rnd.randint(0, 9), 1, 5, "b") for _ in range(50)]
    rows += [("lost", None, rnd.randint(0, 9), 1, 5, "c") for _ in range(20)]
    rows += [(None, rnd.choice([3, None]), rnd.randint(0, 9), 1, 5, "d") for _ in range(20)]
    rows += [(f"7-{rnd.randint(0, 40)}", 7, rnd.randint(0, 9), 1, None, "e") for _ in range(500)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, LINE).repartition(5)


def values(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("partitions", [None, 4])
@pytest.mark.parametrize("hot", [None, [7]])
def test_placed_dedup_keeps_the_same_rows(spark, lines, hot, partitions):
    few = hot and spark.createDataFrame([(h, 4) for h in hot], "order_id long, _salts int")
    spread = spread_keys(lines, "order_item_id", "order_id")
    listed = {r[0] for r in spread.collect()}
    keys = spark.createDataFrame([("moves",), ("lost",), (None,), ("5-0",)], "k string").select(F.xxhash64("k")).collect()
    assert [r[0] in listed for r in keys] == [True, True, True, False]
    want = values(dedup_dataset(lines, "order_items"))
    assert values(dedup_placed(lines, "order_items", "order_id", partitions, few, spread)) == want
    # by its own key nothing is spread
    by_key = few and few.select(F.lit("moves").alias("order_item_id"), "_salts")
    assert values(dedup_placed(lines, "order_items", None, partitions, by_key)) == want


def test_rows_are_not_sorted_before_their_shuffle(spark, lines):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = dedup_placed(lines, "order_items", "order_id", 4)
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    first = plan[: plan.index("REPARTITION_BY_NUM")]  # the side that takes the ordinary rows, from its end to its shuffle
    assert "WindowGroupLimit" in first and "hashpartitioning(order_item_id" not in first
    below = plan[plan.index("REPARTITION_BY_NUM") :].split("Union")[0].split("Window [row_number")[0]
    assert "Sort" not in below and "WindowGroupLimit" not in below


def test_product_mart_without_hot_keys_shuffles_lines_once(spark, scratch):
    orders = spark.createDataFrame([(i, i % 5, "shipped") for i in range(60)], "order_id long, customer_id long, order_status string")
    items = spark.createDataFrame([(i % 60, i % 7, 1, float(i)) for i in range(300)], "order_id long, product_id long, quantity int, line_amount double")
    products = spark.createDataFrame([(i, "p", "c") for i in range(7)], "product_id long, product_name string, category string")
    customers = spark.createDataFrame([(i,) for i in range(4)], "customer_id long")
    none = layers._written_once(f"{scratch}/hot", lambda: customers.limit(0))
    assert none() is None
    hot = {"order_id": none, "customer_id": none}
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = gold.product_revenue(orders, items, products, customers, hot)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "_salt" not in plan and "hashpartitioning(order_id" in plan
        assert not any(p in plan for p in ("hashpartitioning(order_id#0L, product_id", "hashpartitioning(product_id#0L, order_id"))
        assert plan.count("Exchange hashpartitioning(order_id") == 2  # lines and order ids; no (order, product) pairs
        assert values(got) == values(gold.product_revenue(orders, items, products, customers))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
