"""Explicit schemas of the six retail tables, the layer columns and the key map.

Ids are the driver tables' integer keys (``bigint``), or text where the tables
come from CSV sources (``Dataset.source_schema``); ``order_item_id`` is always
text because it is composed from two keys. Money that is summed
(``line_amount``, ``payment_amount``) is ``decimal`` so that every engine
adds it up exactly; it is cast to ``double`` only in final projections.
Event times are ``timestamp_ntz``, as in the driver's Parquet files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

MONEY = DecimalType(18, 4)

CUSTOMERS = StructType(
    [
        StructField("customer_id", LongType(), False),
        StructField("full_name", StringType()),
        StructField("email", StringType()),
        StructField("state", StringType()),
        StructField("created_at", TimestampNTZType()),
    ]
)

PRODUCTS = StructType(
    [
        StructField("product_id", LongType(), False),
        StructField("product_name", StringType()),
        StructField("category", StringType()),
        StructField("unit_price", DoubleType()),
        StructField("active", BooleanType()),
    ]
)

ORDERS = StructType(
    [
        StructField("order_id", LongType(), False),
        StructField("customer_id", LongType(), False),
        StructField("order_timestamp", TimestampNTZType()),
        StructField("order_status", StringType()),
    ]
)

ORDER_ITEMS = StructType(
    [
        StructField("order_item_id", StringType(), False),
        StructField("order_id", LongType(), False),
        StructField("product_id", LongType(), False),
        StructField("quantity", IntegerType()),
        StructField("unit_price", DoubleType()),
        StructField("line_amount", MONEY),
        # source attributes of the line; they make the dedup survivor order total
        StructField("supplier_id", LongType()),
        StructField("ship_date", TimestampNTZType()),
    ]
)

PAYMENTS = StructType(
    [
        StructField("payment_id", LongType(), False),
        StructField("order_id", LongType(), False),
        StructField("payment_method", StringType()),
        StructField("payment_amount", DecimalType(28, 4)),
        StructField("payment_timestamp", TimestampNTZType()),
    ]
)

SHIPMENTS = StructType(
    [
        StructField("shipment_id", LongType(), False),
        StructField("order_id", LongType(), False),
        StructField("shipped_at", TimestampNTZType()),
        StructField("delivered_at", TimestampNTZType()),
        StructField("delivery_status", StringType()),
    ]
)

# The CSV sources carry text ids (``CUST-000042``), and their order lines have
# neither a supplier nor a ship date.
SOURCE_ID_PREFIX = {
    "customer_id": "CUST-",
    "product_id": "PROD-",
    "order_id": "ORD-",
    "payment_id": "PAY-",
    "shipment_id": "SHIP-",
}
SOURCE_ID_WIDTH = 6


def _source_schema(schema: StructType) -> StructType:
    absent = {"supplier_id", "ship_date"}
    return StructType(
        [
            StructField(f.name, StringType()) if f.name in SOURCE_ID_PREFIX else f
            for f in schema.fields
            if f.name not in absent
        ]
    )


# Columns every raw-layer row carries.
LINEAGE = StructType(
    [
        StructField("_ingestion_timestamp", TimestampType()),
        StructField("_source_file", StringType()),
        StructField("_batch_id", StringType()),
    ]
)

QUALITY_METRICS = StructType(
    [
        StructField("dataset", StringType(), False),
        StructField("input_records", LongType(), False),
        StructField("valid_records", LongType(), False),
        StructField("rejected_records", LongType(), False),
        StructField("duplicate_records", LongType(), False),
        StructField("quality_rate", DoubleType(), False),
        StructField("batch_id", StringType()),
    ]
)


# The output columns of the two item-level marts, in order.
MART_COLUMNS = {
    "order_revenue": (
        "order_id customer_id order_timestamp order_status order_revenue items_sold distinct_products"
    ).split(),
    "product_revenue": "product_id product_name category units_sold product_revenue order_count".split(),
}


@dataclass(frozen=True)
class Dataset:
    """A retail table: schema, business key and the dedup survivor order.

    ``survivor_order`` lists the payload columns that, ascending with NULLs
    first, pick the one row kept per key. Rows still tied are identical in
    every retail column, so the survivor is deterministic.
    """

    name: str
    schema: StructType
    key: str
    survivor_order: tuple[str, ...]

    @property
    def source_schema(self) -> StructType:
        """Columns of the table's CSV source."""
        return _source_schema(self.schema)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


# Order matters: it is the ingestion order of the raw layer.
DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset("customers", CUSTOMERS, "customer_id", ("full_name", "email", "state", "created_at")),
        Dataset("products", PRODUCTS, "product_id", ("product_name", "category", "unit_price", "active")),
        Dataset("orders", ORDERS, "order_id", ("customer_id", "order_timestamp", "order_status")),
        Dataset(
            "order_items",
            ORDER_ITEMS,
            "order_item_id",
            ("product_id", "supplier_id", "ship_date", "quantity", "line_amount", "unit_price"),
        ),
        Dataset(
            "payments",
            PAYMENTS,
            "payment_id",
            ("order_id", "payment_method", "payment_amount", "payment_timestamp"),
        ),
        Dataset(
            "shipments",
            SHIPMENTS,
            "shipment_id",
            ("order_id", "shipped_at", "delivered_at", "delivery_status"),
        ),
    )
}


def dataset(name: str) -> Dataset:
    try:
        return DATASETS[name]
    except KeyError:
        raise ValueError(f"no retail table is called {name!r}") from None


def nullable(schema: StructType) -> StructType:
    """The same schema with every field nullable (file sources read it so anyway)."""
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
