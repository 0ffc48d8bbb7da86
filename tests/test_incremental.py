import random

import pytest
from pyspark.sql import functions as F

from strata.plans import gold, incremental
from tests.test_versioned import bucket_files

ORDER = "order_id long, customer_id long, order_timestamp timestamp_ntz, order_status string"
LINE = "order_item_id string, order_id long, product_id long, quantity int, line_amount decimal(18,4)"


def frames(spark, orders, lines):
    from decimal import Decimal

    o = spark.createDataFrame([(i, c, None, s) for i, (c, s) in orders.items()], ORDER)
    rows = [(f"{i}-{k}", i, p, q, Decimal(q) * 3 / 2) for i, ps in lines.items() for k, (p, q) in enumerate(ps)]
    return o, spark.createDataFrame(rows, LINE)


def random_batch(rnd, ids):
    orders = {i: (rnd.randint(0, 9), rnd.choice(["completed", "shipped", "cancelled"])) for i in ids}
    return orders, {i: [(rnd.randint(0, 6), rnd.randint(1, 5)) for _ in range(rnd.randint(0, 4))] for i in ids}


@pytest.fixture()
def dims(spark):
    customers = spark.createDataFrame([(i, f"c{i}") for i in range(8)], "customer_id long, full_name string")  # 8, 9 unknown
    products = spark.createDataFrame([(i, f"p{i}", "even" if i % 2 == 0 else "odd") for i in range(7)], "product_id long, product_name string, category string")
    return customers, products


def test_marts_after_batches_equal_a_rebuild(spark, scratch, dims):
    customers, products = dims
    rnd = random.Random(8)
    orders, lines = random_batch(rnd, range(60))
    tables = incremental.MartTables.at(spark, scratch, buckets=4)
    incremental.load(tables, *frames(spark, orders, lines), customers)
    for ids in (range(50, 75), (3, 4, 5)):  # corrected and new ones; then corrections that cancel
        batch = random_batch(rnd, ids) if len(ids) > 3 else ({i: (1, "cancelled") for i in ids}, {3: [(0, 1)]})
        orders |= batch[0]
        lines |= {i: [] for i in batch[0]} | batch[1]
        incremental.refresh(tables, *frames(spark, *batch), customers)
        o, li = frames(spark, orders, lines)
        want = gold.order_revenue(o, li, customers).collect()
        assert sorted(map(str, incremental.order_mart(tables).collect())) == sorted(map(str, want))
        want = gold.product_revenue(o, li, products, customers)
        got = incremental.product_mart(tables, products)
        key = lambda r: (r.product_id, r.units_sold, r.product_revenue, r.order_count)
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_refresh_leaves_other_orders_alone(spark, scratch, dims):
    customers, _ = dims
    rnd = random.Random(9)
    tables = incremental.MartTables.at(spark, scratch, buckets=64)
    incremental.load(tables, *frames(spark, *random_batch(rnd, range(300))), customers)
    before = {t: bucket_files(t, 1) for t in (tables.orders, tables.lines, tables.order_mart)}
    o, li = frames(spark, {7: (1, "shipped"), 8: (2, "shipped")}, {7: [(0, 2)], 8: [(1, 1)]})
    incremental.refresh(tables, o, li, customers)
    touched = {r[0] for r in o.select(tables.orders._bucket()).collect()}
    for t, files in before.items():
        after = bucket_files(t, 2)
        assert {b for b in files if files[b] != after.get(b)} <= touched
    # what a batch looks up is read from its buckets only
    plan = tables.lines.lookup(o.select("order_id")).inputFiles()
    assert {int(f.split("table_bucket=")[1].split("/")[0]) for f in plan} <= touched


def test_bitmaps_merge_over_batches_and_groups(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), rnd.choice([5, 40_000, 99_999, rnd.randint(0, 200_000)])) for _ in range(3000)] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, id long")
    halves = [incremental.active_bitmaps(df.where(c), "id", ["g"]) for c in ("id % 3 = 0", "id % 3 <> 0 or id is null")]
    both = halves[0].unionByName(halves[1])
    got = {r.g: r.n for r in incremental.merged_count(both, ["g"], "n").collect()}
    assert got == {g: len({i for h, i in rows if h == g and i is not None}) for g in "ab"}
    total = incremental.merged_count(both.withColumn("g", F.lit("all")), ["g"], "n").first().n
    assert total == len({i for _, i in rows if i is not None})


def test_validated_rows_are_deduplicated_once_for_all_batches(spark, scratch, monkeypatch):
    from strata import queries
    from strata.operators import dedup

    placed, seen = queries.layers.dedup_placed, []
    monkeypatch.setattr(queries.layers, "dedup_placed", lambda df, name, *a: seen.append(name) or placed(df, name, *a))
    monkeypatch.setattr(dedup, "dedup_dataset", None)
    tables, s = queries._corrected_load(spark, "/root/testdata/sf0.001")
    assert seen == ["orders", "order_items"]
    assert tables.lines.read().columns == list(incremental.LINE_COLUMNS)  # no column that no mart reads
    want = gold.order_revenue(s.orders, s.order_items, s.customers).collect()
    assert sorted(map(str, incremental.order_mart(tables).collect())) == sorted(map(str, want))


def test_a_large_bucket_is_written_by_several_tasks(spark, scratch):
    from strata.sources.versioned import VersionedTable

    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "4"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        table = VersionedTable(spark, scratch, "id", buckets=2)
        table.create(spark.range(0, 200_000, 1, 8).withColumn("x", F.rand(3)))
        assert all(len(files) > 1 for files in bucket_files(table, 1).values())
        assert table.read().count() == 200_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
