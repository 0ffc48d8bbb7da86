import datetime as dt
from decimal import Decimal

import pytest

from strata.sources import adapter

D = dt.datetime(1995, 1, 1)


@pytest.fixture()
def sf_dir(spark, scratch):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/{name}.parquet")

    put("region", [(0, "AMERICA")], "r_regionkey int, r_name string")
    put("nation", [(1, "BRAZIL", 0)], "n_nationkey int, n_name string, n_regionkey int")
    put(
        "customer",
        [(5, "C5", 1, 0.0, "X"), (7, "C7", 1, 0.0, "X"), (13, "C13", 1, 0.0, "X"), (19, "C19", 1, 0.0, "X"), (21, "C21", 9, 0.0, "X")],
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    )
    put("part", [(20, "p20", "B", "ECONOMY", 1, 10.0), (21, "p21", "B", "STANDARD", 1, 12.5)],
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    put(
        "orders",
        [(1, 5, "F", 1.0, D, "1-URGENT"), (2, 5, "O", 1.0, D, "1-URGENT"), (3, 7, "P", 1.0, D, "5-LOW"), (4, 7, "P", 1.0, D, "2-HIGH")],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    )
    li = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, " \
         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    # (1*7 + 31*3 + 0) % 100 == 0 -> fault on the second line
    put("lineitem", [(1, 20, 1, 1, 2.0, 100.005, 0.1, 0.0, "N", "O", D), (1, 31, 1, 0, 3.0, 30.0, -0.0, 0.0, "N", "O", D)], li)
    return scratch


def test_customers_states_and_email_faults(spark, sf_dir):
    got = {r.customer_id: r for r in adapter.customers(spark, sf_dir).collect()}
    assert got[5].email == "c5@example.com" and got[5].state == "BRAZIL"
    assert (got[7].email, got[13].email, got[19].email) == ("", "   ", None)
    assert got[21].state is None  # unknown nation keeps the customer
    assert {r._batch_id for r in got.values()} == {"batch-0001"} and got[5]._source_file
    assert dict((r.state, r.region) for r in adapter.states(spark, sf_dir).collect()) == {"BRAZIL": "AMERICA"}


def test_orders_status_mapping(spark, sf_dir):
    got = {r.order_id: r.order_status for r in adapter.orders(spark, sf_dir).collect()}
    assert got == {1: "completed", 2: "shipped", 3: "cancelled", 4: "processing"}


def test_items_fault_and_exact_amounts(spark, sf_dir):
    got = {r.order_item_id: r for r in adapter.order_items(spark, sf_dir).collect()}
    assert got["1-1"].line_amount == Decimal("90.0090") and got["1-1"].quantity == 2
    assert got["1-0"].quantity == 0 and got["1-0"].line_amount == Decimal("0.0000")
    assert got["1-0"].unit_price == 10.0


def test_payments_and_shipments(spark, sf_dir):
    pays = adapter.payments(spark, sf_dir).collect()
    assert len(pays) == 1  # only order 1 has lines
    p = pays[0]
    assert (p.payment_id, p.payment_method) == (1, "pix")
    assert p.payment_amount == Decimal("120.0090")  # before fault injection
    assert p.payment_timestamp == D + dt.timedelta(minutes=2)
    ships = {r.order_id: r for r in adapter.shipments(spark, sf_dir).collect()}
    assert set(ships) == {1, 2, 4}  # no shipment for the cancelled order
    assert ships[2].shipped_at == D + dt.timedelta(hours=6)
    assert ships[2].delivered_at == ships[2].shipped_at + dt.timedelta(days=3)


def test_order_of_unknown_status_has_a_shipment(spark, sf_dir):
    rows = [(9, 5, None, 1.0, D, "1-URGENT"), (8, 5, "P", 1.0, D, "5-LOW")]
    schema = spark.read.parquet(f"{sf_dir}/orders.parquet").schema
    spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{sf_dir}/orders.parquet")
    assert 9 in {r.order_id for r in adapter.shipments(spark, sf_dir).collect()}


def test_source_rows_carry_text_ids(spark, sf_dir):
    got = sorted(r.customer_id for r in adapter.source_rows(spark, sf_dir, "customers").collect())
    assert got[0] == "CUST-000005"
    assert "supplier_id" not in adapter.source_rows(spark, sf_dir, "order_items").columns


def test_unknown_dataset(spark, sf_dir):
    with pytest.raises(ValueError):
        adapter.raw_table(spark, sf_dir, "nope")
