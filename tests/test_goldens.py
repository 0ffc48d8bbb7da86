"""Golden values at sf0.01, computed by Spark."""

import os

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def run(spark, name):
    return queries()[name](spark, SF).collect()


def test_kpi_goldens(spark):
    k = run(spark, "business_kpis")[0]
    assert (k.total_orders, k.active_customers, k.total_items_sold) == (9459, 1452, 739631)
    assert k.total_revenue == pytest.approx(1466930938.0655, abs=1e-6)
    assert k.average_order_value == pytest.approx(155083.0889169574, rel=1e-15)


def test_quality_goldens(spark):
    m = {r.dataset: r for r in run(spark, "quality_metrics")}
    assert (m["customers"].valid_records, m["customers"].rejected_records) == (1455, 45)
    items = m["order_items"]
    assert (items.input_records, items.valid_records, items.rejected_records, items.duplicate_records) == (
        60000, 45526, 572, 13902,
    )


def test_mart_goldens(spark):
    p0 = [r for r in run(spark, "product_revenue") if r.product_id == 0][0]
    assert (p0.units_sold, p0.order_count) == (675, 23) and p0.product_revenue == pytest.approx(1259512.5194)
    economy = [r for r in run(spark, "category_revenue") if r.category == "ECONOMY"][0]
    assert (economy.units_sold, economy.product_order_occurrences) == (113649, 4456)
    assert economy.category_revenue == pytest.approx(223350239.9323)
    c0 = [r for r in run(spark, "customer_revenue") if r.customer_id == 0][0]
    assert (c0.order_count, c0.items_purchased) == (8, 639) and c0.average_order_value == pytest.approx(184087.1827875)
    top = [r for r in run(spark, "top_products_by_category") if r.category == "ECONOMY" and r.product_rank == 1][0]
    assert top.product_id == 251 and top.product_revenue == pytest.approx(1713902.5463)


def test_metric_goldens(spark):
    c = run(spark, "cancellation_rate")[0]
    assert (c.total_orders, c.cancelled_orders) == (15000, 1021)
    assert run(spark, "customer_recurrence")[0].repeat_rate == pytest.approx(0.9855371900826446)
    assert len(run(spark, "revenue_by_region")) == 31
    assert len(run(spark, "cancelled_with_items")) == 1005
