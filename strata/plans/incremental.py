"""Marts kept up to date from batches, without building them again.

The state is four versioned tables: validated orders and order lines (the columns that
the marts read), the order mart, and the product mart's sums. A batch brings whole orders (new ones,
and corrected ones that replace what was loaded before). Its signed delta goes through
the marts' own plan: the lines of the batch's orders before (-1) and after (+1) it are
joined with their eligible orders and summed per product. Orders and products that the
batch does not name are neither read, beyond the buckets they share, nor written again.

The number of different orders per product is exact under corrections, since a batch
holds an order whole: it is the sum of +1 and -1 over the (product, order) pairs of the
batch's orders. Where rows are only ever added, ``active_bitmaps`` keeps distinct counts
that merge over any roll-up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import hot_keys
from strata.plans import gold
from strata.schemas import MART_COLUMNS
from strata.sources.versioned import VersionedTable, staged

ORDER_COLUMNS = ("order_id", "customer_id", "order_timestamp", "order_status")
LINE_COLUMNS = ("order_id", "product_id", "quantity", "line_amount")
SUMS = ("units_sold", "product_revenue", "order_count")


@dataclass(frozen=True)
class MartTables:
    orders: VersionedTable
    lines: VersionedTable
    order_mart: VersionedTable
    product_sums: VersionedTable

    @classmethod
    def at(cls, spark: SparkSession, root: str, buckets: int = 64) -> "MartTables":
        keys = {"orders": "order_id", "lines": "order_id", "order_mart": "order_id", "product_sums": "product_id"}
        return cls(**{n: VersionedTable(spark, f"{root}/{n}", key, buckets) for n, key in keys.items()})


def _product_parts(orders: DataFrame, lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Units, revenue and number of orders per product of the eligible orders."""
    eligible = gold.eligible_orders(orders, customers).select("order_id")
    items = lines.join(eligible, "order_id", "left_semi")
    # one row per (product, order) first: a pair counts once, and sums stay exact
    pairs = items.groupBy("product_id", "order_id").agg(
        F.sum("quantity").alias("units"), F.sum("line_amount").alias("revenue")
    )
    return pairs.groupBy("product_id").agg(
        F.sum("units").alias("units_sold"),
        F.sum("revenue").cast("decimal(38,4)").alias("product_revenue"),
        F.count(F.lit(1)).alias("order_count"),
    )


def _by_order(lines: DataFrame) -> DataFrame:
    """Lines placed by order, so that totals per order and (product, order) pairs need no further shuffle;
    where an order is hot they stay where they are, and partial sums cut it down."""
    return lines.repartition("order_id") if hot_keys(lines, ["order_id"]).isEmpty() else lines


def load(tables: MartTables, orders: DataFrame, lines: DataFrame, customers: DataFrame) -> None:
    """First batch: the state as it is after ``orders`` and their ``lines`` (both validated)."""
    tables.orders.create(orders.select(*ORDER_COLUMNS))
    tables.lines.create(lines.select(*LINE_COLUMNS))
    stored_orders, stored_lines = tables.orders.read(), _by_order(tables.lines.read())
    tables.order_mart.create(gold.order_revenue(stored_orders, stored_lines, customers))
    tables.product_sums.create(_product_parts(stored_orders, stored_lines, customers))


def refresh(tables: MartTables, orders: DataFrame, lines: DataFrame, customers: DataFrame) -> None:
    """Apply a batch of whole orders (validated ``orders`` and ``lines``) to the state.

    The keys of the batch are the ids in ``orders``; a key without lines loses those it had.
    Customers are the current dimension; they must not have changed since the load.
    The tables' rows of the keys are read once, as they were before; afterwards they are the
    batch's own.
    """
    orders, lines = orders.select(*ORDER_COLUMNS), lines.select(*LINE_COLUMNS)
    keys = staged(orders.select("order_id").distinct())
    state = (tables.orders, tables.lines)
    old = [t.lookup(keys) for t in state]
    new = [staged(rows.join(keys, "order_id", "left_semi")) for rows in (orders, lines)]
    tables.orders.replace(orders, keys)
    tables.lines.replace(lines, keys)
    new[1] = _by_order(new[1])
    tables.order_mart.replace(gold.order_revenue(*new, customers), keys)

    signed = None
    for rows, sign in ((old, -1), (new, 1)):
        part = _product_parts(*rows, customers)
        part = part.select("product_id", *[(F.col(c) * sign).alias(c) for c in part.columns[1:]])
        signed = part if signed is None else signed.unionByName(part)
    delta = signed.groupBy("product_id").agg(*[F.sum(c).alias(c) for c in SUMS])
    moved = F.lit(False)
    for c in SUMS:
        moved = moved | (F.col(c) != 0)
    tables.product_sums.add(delta.where(moved), SUMS, present="order_count")


def order_mart(tables: MartTables) -> DataFrame:
    return tables.order_mart.read()


def product_mart(tables: MartTables, products: DataFrame) -> DataFrame:
    """The product mart: the kept sums with the current product names."""
    named = products.select("product_id", "product_name", "category").join(tables.product_sums.read(), "product_id")
    return named.select(*MART_COLUMNS["product_revenue"])


def active_bitmaps(rows: DataFrame, key: str, by: list[str]) -> DataFrame:
    """The different ``key`` values (non-negative integers) per ``by`` as bitmaps of 32 k bits,
    one row per (``by``, range of values): unions of them, over batches or groups, stay exact."""
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(*by, F.bitmap_bucket_number(key).alias("range"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))
    )


def merged_count(bitmaps: DataFrame, by: list[str], out: str) -> DataFrame:
    """Distinct values per ``by`` from the bitmaps of finer groups or of several batches."""
    ranges = bitmaps.groupBy(*by, "range").agg(F.bitmap_or_agg("bits").alias("bits"))
    return ranges.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(out))
