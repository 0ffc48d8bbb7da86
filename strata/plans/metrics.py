"""Business metrics beyond the five marts (pure DataFrame -> DataFrame).

Inputs are validated tables or the order mart. Money stays decimal until
the query's final projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.money import safe_ratio
from strata.operators.joins import skew_join
from strata.operators.windows import running_total, top_k

ON_TIME_DAYS = 5  # fixed: a delivery within 5 days of shipping is on time


def delivery_performance(shipments: DataFrame) -> DataFrame:
    """Transit days (ship -> delivery) by delivery status and ship month."""
    days = F.datediff(F.col("delivered_at"), F.col("shipped_at"))
    return (
        shipments.select(
            "delivery_status",
            F.trunc(F.to_date("shipped_at"), "month").alias("ship_month"),
            days.alias("_days"),
        )
        .groupBy("delivery_status", "ship_month")
        .agg(
            F.count(F.lit(1)).alias("shipments"),
            F.avg("_days").alias("avg_transit_days"),
            F.max("_days").alias("max_transit_days"),
            safe_ratio(F.count_if(F.col("_days") <= ON_TIME_DAYS), F.count("_days")).alias("on_time_rate"),
        )
    )


def cancellation_rate(orders: DataFrame) -> DataFrame:
    """One row: all orders, cancelled orders, their ratio (NULL on no orders)."""
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("order_status") == "cancelled").alias("cancelled_orders"),
    ).withColumn("cancellation_rate", safe_ratio(F.col("cancelled_orders"), F.col("total_orders")))


def cancellation_by_month(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(F.trunc(F.to_date("order_timestamp"), "month").alias("order_month"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.count_if(F.col("order_status") == "cancelled").alias("cancelled_orders"),
        )
        .withColumn("cancellation_rate", safe_ratio(F.col("cancelled_orders"), F.col("total_orders")))
    )


def customer_recurrence(order_revenue: DataFrame) -> DataFrame:
    """Share of active customers with at least two eligible orders (one row)."""
    per_customer = order_revenue.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_orders"))
    return per_customer.agg(
        F.count(F.lit(1)).alias("active_customers"),
        F.count_if(F.col("_orders") >= 2).alias("repeat_customers"),
    ).withColumn("repeat_rate", safe_ratio(F.col("repeat_customers"), F.col("active_customers")))


def customer_lifetime(order_revenue: DataFrame) -> DataFrame:
    """Per customer: first/last eligible order, tenure in days, orders, revenue to date."""
    return (
        order_revenue.groupBy("customer_id")
        .agg(
            F.min("order_timestamp").alias("first_order_at"),
            F.max("order_timestamp").alias("last_order_at"),
            F.count(F.lit(1)).alias("orders"),
            F.sum("order_revenue").alias("lifetime_revenue"),
        )
        .withColumn("tenure_days", F.datediff(F.col("last_order_at"), F.col("first_order_at")))
    )


def customer_running_revenue(order_revenue: DataFrame) -> DataFrame:
    """Revenue to date after each eligible order of a customer.

    Blocks are order days, so one very large customer is processed as many
    (customer, day) groups.
    """
    base = order_revenue.select("customer_id", "order_timestamp", "order_id", "order_revenue")
    return running_total(
        base,
        ["customer_id"],
        ["order_timestamp", "order_id"],
        "order_revenue",
        F.to_date("order_timestamp"),
        out="running_revenue",
    )


def revenue_by_region(customer_revenue: DataFrame, states: DataFrame) -> DataFrame:
    """Customer revenue by region and state, with region subtotals and a grand total.

    ``level`` is 0 for a state, 1 for a region and 3 for the grand total, which tells
    totals from unknown states and regions.

    ``states`` has one row per state (nation), which Spark broadcasts by its own
    size check, so customers are not shuffled onto a handful of state keys.
    """
    return (
        customer_revenue.join(states, "state", "left")
        .rollup("region", "state")
        .agg(
            F.grouping_id().alias("level"),
            F.sum("customer_revenue").alias("revenue"),
            F.sum("order_count").alias("orders"),
            F.count(F.lit(1)).alias("customers"),
        )
    )


def top_products_by_category(product_revenue: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` products by revenue in each category (ties by product id)."""
    ranked = top_k(
        product_revenue.select("category", "product_id", "product_name", "product_revenue"),
        ["category"],
        [F.col("product_revenue").desc_nulls_last(), F.col("product_id").asc()],
        k,
        rank_col="product_rank",
    )
    return ranked.select("category", "product_rank", "product_id", "product_name", "product_revenue")


def fact_order_items(
    order_items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    states: DataFrame,
    hot: dict | None = None,
) -> DataFrame:
    """Item-grain fact with order, customer, region and product columns.

    Every valid item is kept (left joins). Customer columns are attached at
    order grain first, so the item-grain joins are on order_id and
    product_id only, each salted on its hot keys.
    """
    hot = hot or {}
    order_dims = skew_join(
        orders.select("order_id", "customer_id", "order_timestamp", "order_status"),
        customers.select("customer_id", "state").join(states, "state", "left"),
        "customer_id",
        "left",
        hot.get("customer_id"),
    )
    items = order_items.select("order_item_id", "order_id", "product_id", "quantity", "line_amount")
    with_orders = skew_join(items, order_dims, "order_id", "left", hot.get("order_id"))
    return skew_join(
        with_orders,
        products.select("product_id", "product_name", "category"),
        "product_id",
        "left",
        hot.get("product_id"),
    ).select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "line_amount",
        "customer_id",
        "order_timestamp",
        "order_status",
        "state",
        "region",
        "product_name",
        "category",
    )
