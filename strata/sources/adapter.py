"""Driver tables -> the six raw retail tables (plus the state -> region lookup).

The mapping is fixed so that an independent SQL engine can repeat it:

* customers: ``c_custkey``, ``c_name``, nation name as state; e-mail is
  ``c<custkey>@example.com`` except for three injected faults by
  ``custkey % 100`` (7: empty, 13: three spaces, 19: NULL). ``created_at``
  has no source column and stays NULL.
* products: ``p_partkey``, ``p_name``, ``p_type`` as category,
  ``p_retailprice``; ``active`` is false for every 20th part.
* orders: status F -> completed, O -> shipped, P -> cancelled when the
  priority is ``5-LOW`` else processing.
* order_items: one per lineitem, key ``<orderkey>-<linenumber>`` (not unique
  in the driver data, which exercises dedup), with the line's supplier and
  ship date. An injected fault (key predicate below) zeroes quantity and
  amount.
* payments: one per order that has lines; amount = exact sum of the lines
  before faults; method and time offsets from the order key.
* shipments: one per order not known to be cancelled; shipped 4..72 h after the order,
  delivered 1..10 days after shipping.

Every raw row also carries the lineage columns of the raw layer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.ids import DEFAULT_BATCH_ID, composed_key, display_id
from strata.functions.money import line_amount
from strata.schemas import DATASETS, SOURCE_ID_PREFIX, SOURCE_ID_WIDTH
from strata.sources.driver import read_table

# Fixed values of the mapping (must stay equal to the SQL oracle).
PAYMENT_METHODS = ("credit_card", "pix", "debit_card", "bank_slip")
CANCELLED_PRIORITY = "5-LOW"
FAULT_MODULUS = 100


def with_lineage(df: DataFrame, source: Column, batch_id: str) -> DataFrame:
    return df.withColumns(
        {
            "_ingestion_timestamp": F.current_timestamp(),
            "_source_file": source,
            "_batch_id": F.lit(batch_id),
        }
    )


def _file(df: DataFrame) -> Column:
    # input_file_name() is pruned from the scan when a plan does not use the
    # column; a `_metadata` reference makes Spark read every metadata field.
    return F.input_file_name()


def customers(spark: SparkSession, sf_dir: str, batch_id: str = DEFAULT_BATCH_ID) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    email = (
        F.when(key % 100 == 7, F.lit(""))
        .when(key % 100 == 13, F.lit("   "))
        .when(key % 100 == 19, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")))
    )
    base = c.select("c_custkey", "c_name", "c_nationkey", _file(c).alias("_src"))
    # nation has one row per country: Spark broadcasts it by its own size check
    out = base.join(n, base.c_nationkey == n.n_nationkey, "left").select(
        key.alias("customer_id"),
        F.col("c_name").alias("full_name"),
        email.alias("email"),
        F.col("n_name").alias("state"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        "_src",
    )
    return with_lineage(out, F.col("_src"), batch_id).drop("_src")


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """state (nation name) -> region name lookup."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_name").alias("state"), F.col("r_name").alias("region")
    )


def products(spark: SparkSession, sf_dir: str, batch_id: str = DEFAULT_BATCH_ID) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    out = p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
        (F.col("p_partkey") % 20 != 0).alias("active"),
    )
    return with_lineage(out, _file(p), batch_id)


def order_status(status: Column, priority: Column) -> Column:
    return (
        F.when(status == "F", F.lit("completed"))
        .when(status == "O", F.lit("shipped"))
        .when((status == "P") & (priority == CANCELLED_PRIORITY), F.lit("cancelled"))
        .when(status == "P", F.lit("processing"))
    )


def orders(spark: SparkSession, sf_dir: str, batch_id: str = DEFAULT_BATCH_ID) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    out = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        order_status(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("order_status"),
    )
    return with_lineage(out, _file(o), batch_id)


def item_fault() -> Column:
    """Deterministic fault injection: about 1 line in 100."""
    return (F.col("l_orderkey") * 7 + F.col("l_partkey") * 3 + F.col("l_linenumber")) % FAULT_MODULUS == 0


def order_items(spark: SparkSession, sf_dir: str, batch_id: str = DEFAULT_BATCH_ID) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    fault = item_fault()
    qty = F.col("l_quantity")
    out = li.select(
        composed_key("l_orderkey", "l_linenumber").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(fault, F.lit(0)).otherwise(qty.cast("int")).alias("quantity"),
        F.when(qty == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice") / qty)
        .alias("unit_price"),
        F.when(fault, F.lit(0).cast(DATASETS["order_items"].schema["line_amount"].dataType))
        .otherwise(line_amount("l_extendedprice", "l_discount"))
        .alias("line_amount"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_shipdate").alias("ship_date"),
    )
    return with_lineage(out, _file(li), batch_id)


def payments(spark: SparkSession, sf_dir: str, batch_id: str = DEFAULT_BATCH_ID) -> DataFrame:
    """One payment per order with lines, amount before fault injection.

    Lines are summed per order first (map-side partial sums), so only one
    row per order reaches the join with ``orders``.
    """
    li = read_table(spark, sf_dir, "lineitem")
    totals = li.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum(line_amount("l_extendedprice", "l_discount")).alias("payment_amount")
    )
    o = read_table(spark, sf_dir, "orders")
    od = o.select(F.col("o_orderkey").alias("order_id"), "o_orderdate", _file(o).alias("_src"))
    methods = F.array(*[F.lit(m) for m in PAYMENT_METHODS])
    out = od.join(totals, "order_id", "inner").select(
        F.col("order_id").alias("payment_id"),
        "order_id",
        F.element_at(methods, (F.col("order_id") % 4 + 1).cast("int")).alias("payment_method"),
        "payment_amount",
        F.timestamp_add("MINUTE", F.col("order_id") % 120 + 1, F.col("o_orderdate")).alias(
            "payment_timestamp"
        ),
        "_src",
    )
    return with_lineage(out, F.col("_src"), batch_id).drop("_src")


def shipments(spark: SparkSession, sf_dir: str, batch_id: str = DEFAULT_BATCH_ID) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    status = order_status(F.col("o_orderstatus"), F.col("o_orderpriority"))
    shipped = F.timestamp_add("HOUR", F.col("o_orderkey") % 69 + 4, F.col("o_orderdate"))
    out = o.where(~status.eqNullSafe("cancelled")).select(
        F.col("o_orderkey").alias("shipment_id"),
        F.col("o_orderkey").alias("order_id"),
        shipped.alias("shipped_at"),
        F.timestamp_add("DAY", F.col("o_orderkey") % 10 + 1, shipped).alias("delivered_at"),
        F.lit("delivered").alias("delivery_status"),
    )
    return with_lineage(out, _file(o), batch_id)


READERS = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "shipments": shipments,
}


def raw_table(spark: SparkSession, sf_dir: str, name: str, batch_id: str = DEFAULT_BATCH_ID) -> DataFrame:
    try:
        reader = READERS[name]
    except KeyError:
        raise ValueError(f"no retail table is called {name!r}") from None
    return reader(spark, sf_dir, batch_id)


BLANK_ID_REMAINDER = 37  # rows of this key remainder (by FAULT_MODULUS) lose their id in source_rows(blank_ids=True)


def source_rows(spark: SparkSession, sf_dir: str, name: str, blank_ids: bool = False) -> DataFrame:
    """A raw table as its source system exports it: text ids, source columns only.

    ``blank_ids`` injects a fault: the key becomes three spaces (customers) or the
    order's id empty (order lines) where the customer or order key says so.
    """
    ds = DATASETS[name]
    raw = raw_table(spark, sf_dir, name)

    def column(c: str) -> Column:
        if c not in SOURCE_ID_PREFIX:
            return F.col(c)
        text = display_id(SOURCE_ID_PREFIX[c], c, SOURCE_ID_WIDTH)
        fault = {"customers": ("customer_id", "   "), "order_items": ("order_id", "")}.get(name)
        if blank_ids and fault and c == fault[0]:
            text = F.when(F.col(c) % FAULT_MODULUS == BLANK_ID_REMAINDER, F.lit(fault[1])).otherwise(text)
        return F.when(F.col(c).isNotNull(), text).alias(c)

    return raw.select(*[column(f.name) for f in ds.source_schema.fields])


ORPHAN_REMAINDER = 3
CANCELLED_REMAINDER = 9
NOWHERE = 10**15  # added to a key, it meets no row


def with_broken_links(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw tables with injected faults for the integrity checks: about one child row in a
    hundred points nowhere, and about one order in a hundred is cancelled after shipping."""

    def broken(df: DataFrame, key: str, by: str) -> DataFrame:
        lost = F.col(by) % FAULT_MODULUS == ORPHAN_REMAINDER
        return df.withColumn(key, F.when(lost, F.col(key) + F.lit(NOWHERE)).otherwise(F.col(key)))

    cancelled = F.col("order_id") % FAULT_MODULUS == CANCELLED_REMAINDER
    orders = raw["orders"].withColumn(
        "order_status", F.when(cancelled, F.lit("cancelled")).otherwise(F.col("order_status"))
    )
    items = broken(raw["order_items"], "product_id", "product_id")
    return raw | {
        "orders": broken(orders, "customer_id", "customer_id"),
        "order_items": broken(items, "order_id", "order_id"),
        "payments": broken(raw["payments"], "order_id", "payment_id"),
        "shipments": broken(raw["shipments"], "order_id", "shipment_id"),
    }
