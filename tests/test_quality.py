import math

import pytest
from pyspark.sql import functions as F

from strata.operators import quality
from strata.schemas import CUSTOMERS as _CUSTOMERS, ORDER_ITEMS as _ORDER_ITEMS, nullable

CUSTOMERS, ORDER_ITEMS = nullable(_CUSTOMERS), nullable(_ORDER_ITEMS)

CUSTOMER_ROWS = [
    (1, "Ann", "a@x.com", "S1", None),
    (None, "NoId", "n@x.com", "S1", None),  # NULL id
    (3, "Tab", "\t", "S1", None),  # tab-only e-mail: trim strips spaces only -> valid
    (4, "Space", "   ", "S1", None),  # spaces only -> rejected
    (5, "Empty", "", "S1", None),  # empty -> rejected
    (6, "Null", None, "S1", None),  # NULL -> rejected
    (7, "Dup-b", "b@x.com", "S2", None),
    (7, "Dup-a", "a@x.com", "S2", None),  # duplicate id with another payload
]


def items(spark, rows):
    """Order lines without supplier and ship date (not checked by any rule)."""
    return spark.createDataFrame([r + (None, None) for r in rows], ORDER_ITEMS)


def test_customer_split_is_exact(spark):
    df = spark.createDataFrame(CUSTOMER_ROWS, CUSTOMERS)
    valid, rejected = quality.split_by_quality(df, "customers")
    assert valid.count() + rejected.count() == df.count()
    assert sorted(r.customer_id for r in rejected.collect() if r.customer_id) == [4, 5, 6]
    assert {r._dq_reason for r in rejected.collect()} == {"missing_required_customer_fields"}
    assert 3 in {r.customer_id for r in valid.collect()}


def test_order_item_rules(spark):
    nan = float("nan")
    rows = [
        ("a", 1, 1, 1, 10.0, None),  # NULL line_amount is not checked -> valid
        ("b", 1, 1, None, 10.0, None),  # quantity NULL
        ("c", 1, 1, 0, 10.0, None),  # quantity 0
        ("d", 1, 1, -1, 10.0, None),  # quantity < 0
        ("e", 1, 1, 1, None, None),  # price NULL
        ("f", 1, 1, 1, -0.01, None),  # negative price
        ("g", 1, 1, 1, 0.0, None),  # zero price -> valid
        ("h", 1, 1, 1, nan, None),  # NaN price -> valid (NaN < 0 is false)
        (" ", 1, 1, 1, 1.0, None),  # blank id
        ("i", None, 1, 1, 1.0, None),  # NULL order id
    ]
    valid, rejected = quality.split_by_quality(items(spark, rows), "order_items")
    assert sorted(r.order_item_id for r in valid.collect()) == ["a", "g", "h"]
    assert rejected.count() == 7


def test_failed_rules_lists_every_rule(spark):
    df = items(spark, [(" ", None, 1, 0, -1.0, None)])
    out = df.select(quality.failed_rules(quality.rules_for("order_items")).alias("r")).first().r
    assert out == ["order_item_id_missing", "order_id_missing", "quantity_not_positive", "unit_price_negative"]


def test_metrics_count_duplicates_and_empty(spark):
    df = spark.createDataFrame(CUSTOMER_ROWS, CUSTOMERS)
    m = quality.quality_metrics(df, "customers", "b1").first()
    assert (m.input_records, m.rejected_records, m.valid_records, m.duplicate_records) == (8, 4, 3, 1)
    assert math.isclose(m.quality_rate, 3 / 8)
    empty = spark.createDataFrame([], CUSTOMERS)
    e = quality.quality_metrics(empty, "customers", "b1").first()
    assert (e.input_records, e.valid_records, e.quality_rate) == (0, 0, 0.0)


def test_passthrough_null_keys_collapse(spark):
    from strata.schemas import PRODUCTS, nullable

    df = spark.createDataFrame([(None, "a", "c", 1.0, True), (None, "b", "c", 1.0, True), (1, "x", "c", 1.0, True)], nullable(PRODUCTS))
    m = quality.quality_metrics(df, "products", "b1").first()
    assert (m.valid_records, m.duplicate_records, m.rejected_records) == (2, 1, 0)


def test_rule_failures_and_gate(spark):
    df = spark.createDataFrame(CUSTOMER_ROWS, CUSTOMERS)
    rf = {r.rule: (r.failures, r.rate) for r in quality.rule_failures(df, "customers").collect()}
    assert rf["customer_id_missing"][0] == 1 and rf["email_missing"][0] == 3
    metrics = quality.quality_metrics(df, "customers", "b1")
    assert quality.quality_gate(metrics, 0.9).first().passed is False
    assert quality.quality_gate(metrics, 0.3).first().passed is True
    with pytest.raises(Exception, match="quality gate failed"):
        quality.enforce_gate(metrics, 0.9).collect()
    assert quality.enforce_gate(metrics, 0.3).first().passed is True


def test_total_predicate_never_null(spark):
    from strata.functions.predicates import total

    df = spark.createDataFrame([(1,), (0,), (None,)], "q int")
    assert df.where(total(F.col("q") <= 0)).count() + df.where(~total(F.col("q") <= 0)).count() == 3


def test_rejected_rows_can_list_failed_rules(spark):
    df = items(spark, [("a", 1, 1, 0, -1.0, None), ("b", 1, 1, 1, 1.0, None)])
    _, rejected = quality.split_by_quality(df, "order_items", with_failed_rules=True)
    r = rejected.collect()
    assert len(r) == 1 and r[0]._dq_failed_rules == ["quantity_not_positive", "unit_price_negative"]
    assert r[0]._dq_reason == "invalid_order_item"
