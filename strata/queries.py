"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables under ``sf_dir`` and runs the whole
chain (raw -> validated -> mart) as one lazy Spark plan. Final projections
cast ``decimal`` money to ``double`` and leave out the two lineage columns
whose values depend on the run (load time, file path).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from strata.functions.ids import DEFAULT_BATCH_ID, batch_id_of, display_id
from strata.operators import drift, quality
from strata.operators.dedup import upsert
from strata.operators.ranking import global_rank
from strata.operators.asof import asof_join, intervals
from strata.plans import checks, gold, incremental, layers, metrics
from strata.plans.silver import Silver, validate
from strata.schemas import DATASETS
from strata.session import scratch_path, scratch_root
from strata.sources import adapter, catalog, csv_files, evolution
from strata.sources.adapter import raw_table
from strata.sources.driver import read_table, table_path
from strata.sources.sinks import append_partition, write_clustered, write_table
from strata.sources.versioned import VersionedTable, staged
from strata.streaming import events

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

UNSTABLE = ("_ingestion_timestamp", "_source_file")


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        return fn

    return register


def finalize(df: DataFrame) -> DataFrame:
    """Money to double; run-dependent lineage columns dropped."""
    cols = []
    for f in df.schema.fields:
        if f.name in UNSTABLE:
            continue
        c = F.col(f"`{f.name}`")
        cols.append(c.cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else c)
    return df.select(*cols)


# ---------------------------------------------------------------- validated layer


def _validated(name: str, side: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(validate(raw_table(spark, sf_dir, name), name)[side])

    return run


for _name in DATASETS:
    query(f"silver_{_name}")(_validated(_name, 0))
for _name in quality.REASONS:
    query(f"rejected_{_name}")(_validated(_name, 1))


@query("quality_metrics")
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per raw table: input, valid (after dedup), rejected and duplicate rows, quality rate."""
    parts = [quality.quality_metrics(raw_table(spark, sf_dir, n), n, DEFAULT_BATCH_ID) for n in DATASETS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- marts


@query("eligible_orders")
def eligible_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commercial (completed / shipped) orders of validated customers."""
    s = Silver(spark, sf_dir)
    return finalize(gold.eligible_orders(s.orders, s.customers, s.mart_hot_keys()))


def _order_revenue(s: Silver) -> DataFrame:
    return s.cached(
        "order_revenue", lambda: gold.order_revenue(s.orders, s.order_items, s.customers, s.mart_hot_keys())
    )


def _product_revenue(s: Silver) -> DataFrame:
    return s.cached(
        "product_revenue",
        lambda: gold.product_revenue(s.orders, s.order_items, s.products, s.customers, s.mart_hot_keys()),
    )


@query("order_revenue")
def order_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order mart: revenue, items and distinct products per eligible order (the flagship query)."""
    return finalize(_order_revenue(Silver(spark, sf_dir)))


@query("product_revenue")
def product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product mart: units, revenue and orders per product over eligible orders."""
    return finalize(_product_revenue(Silver(spark, sf_dir)))


@query("category_revenue")
def category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category mart, aggregated from the product mart."""
    return finalize(gold.category_revenue(_product_revenue(Silver(spark, sf_dir))))


@query("customer_revenue")
def customer_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer mart: orders, revenue, average order value and items per customer."""
    s = Silver(spark, sf_dir)
    return finalize(gold.customer_revenue(s.customers, _order_revenue(s)))


@query("business_kpis")
def business_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-row KPI table over the order mart."""
    return finalize(gold.business_kpis(_order_revenue(Silver(spark, sf_dir))))


@query("status_counts")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated orders per status."""
    orders = Silver(spark, sf_dir).orders
    return orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("n")).orderBy("order_status")


# ---------------------------------------------------------------- checks and derived tables


def _raw_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: raw_table(spark, sf_dir, n) for n in DATASETS}


@query("integrity_report")
def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts, referential orphans and fault counts of the raw tables, with injected broken links."""
    return checks.integrity_report(adapter.with_broken_links(_raw_all(spark, sf_dir)))


@query("cancelled_with_items")
def cancelled_with_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cancelled orders that have lines (set intersection)."""
    return checks.cancelled_with_items(raw_table(spark, sf_dir, "orders"), raw_table(spark, sf_dir, "order_items"))


_RUNS: dict[tuple, layers.LayerPaths] = {}


#: Driver tables that an on-disk run reads.
_RUN_INPUTS = ("customer", "nation", "part", "orders", "lineitem")


def _input_state(spark: SparkSession, sf_dir: str) -> tuple[int, ...]:
    """One number per input table, from the path, size and time of each of its files (0: no such table)."""
    facts = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    state = []
    for name in _RUN_INPUTS:
        try:
            files = read_table(spark, sf_dir, name).select(facts.alias("h")).distinct()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            state.append(0)
            continue
        state.append(files.agg(F.coalesce(F.bit_xor("h"), F.lit(0))).first()[0])
    return tuple(state)


def _on_disk_run(spark: SparkSession, sf_dir: str) -> layers.LayerPaths:
    """The tables of a full on-disk run; the queries that read written layers share one per application
    and state of the input files."""
    key = (spark.sparkContext.applicationId, sf_dir, _input_state(spark, sf_dir))
    if key not in _RUNS:
        _RUNS[key] = layers.run_all(spark, sf_dir, scratch_path(spark, "layers"))
    return _RUNS[key]


def _written_mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_on_disk_run(spark, sf_dir).gold(name))


@query("written_order_revenue")
def written_order_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order mart as an on-disk run has written it."""
    return finalize(_written_mart(spark, sf_dir, "order_revenue"))


@query("written_business_kpis")
def written_business_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI table as an on-disk run has written it."""
    return finalize(_written_mart(spark, sf_dir, "business_kpis"))


@query("reconcile_gold")
def reconcile_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals that must agree across the written marts, side by side."""
    marts = {m: _written_mart(spark, sf_dir, m) for m in layers.MARTS}
    orders_mart, products_mart = marts["order_revenue"], marts["product_revenue"]
    categories, customers_mart = marts["category_revenue"], marts["customer_revenue"]
    frames = {
        "orders": (
            orders_mart,
            {
                "order_mart_customers": F.count_distinct("customer_id"),
                "order_mart_revenue": F.sum("order_revenue"),
                "order_mart_items": F.sum("items_sold"),
            },
        ),
        "products": (
            products_mart,
            {"product_mart_revenue": F.sum("product_revenue"), "product_mart_units": F.sum("units_sold")},
        ),
        "categories": (categories, {"category_mart_revenue": F.sum("category_revenue")}),
        "customers": (
            customers_mart,
            {"customer_mart_rows": F.count(F.lit(1)), "customer_mart_revenue": F.sum("customer_revenue")},
        ),
    }
    pairs = [
        ("active_customers_vs_customer_mart", "order_mart_customers", "customer_mart_rows"),
        ("category_total_vs_kpi_total", "category_mart_revenue", "order_mart_revenue"),
        ("product_total_vs_category_total", "product_mart_revenue", "category_mart_revenue"),
        ("customer_total_vs_kpi_total", "customer_mart_revenue", "order_mart_revenue"),
        ("items_sold_vs_units_sold", "order_mart_items", "product_mart_units"),
    ]
    return checks.reconcile(frames, pairs, tolerance=0.005)


@query("layer_checks")
def layer_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postconditions of every written layer as violation counts (0 = pass), and duplicates dropped."""
    paths = _on_disk_run(spark, sf_dir)
    sources = {"customers": "customer", "products": "part", "orders": "orders", "order_items": "lineitem"}
    return checks.layer_checks(
        {n: spark.read.parquet(paths.raw(n)) for n in DATASETS},
        {n: read_table(spark, sf_dir, t) for n, t in sources.items()},
        {n: paths.read_silver(spark, n) for n in DATASETS},
        {n: paths.read_rejected(spark, n) for n in quality.REASONS},
        *[
            _written_mart(spark, sf_dir, m)
            for m in ("order_revenue", "customer_revenue", "category_revenue", "product_revenue")
        ],
    )


@query("payments_derived")
def payments_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments derived per order from the lines (before fault injection)."""
    return finalize(raw_table(spark, sf_dir, "payments"))


@query("shipments_derived")
def shipments_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments derived per order not known to be cancelled."""
    return finalize(raw_table(spark, sf_dir, "shipments"))


# ---------------------------------------------------------------- business metrics


@query("delivery_performance")
def delivery_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transit days and on-time rate by delivery status and ship month."""
    return metrics.delivery_performance(Silver(spark, sf_dir).shipments)


@query("cancellation_rate")
def cancellation_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of cancelled orders (one row)."""
    return metrics.cancellation_rate(Silver(spark, sf_dir).orders)


@query("cancellation_by_month")
def cancellation_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of cancelled orders per order month."""
    return metrics.cancellation_by_month(Silver(spark, sf_dir).orders)


@query("customer_recurrence")
def customer_recurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of active customers with at least two eligible orders (one row)."""
    return metrics.customer_recurrence(_order_revenue(Silver(spark, sf_dir)))


@query("customer_lifetime")
def customer_lifetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First/last order, tenure, orders and revenue per active customer."""
    return finalize(metrics.customer_lifetime(_order_revenue(Silver(spark, sf_dir))))


@query("customer_running_revenue")
def customer_running_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue to date after each eligible order of a customer."""
    return finalize(metrics.customer_running_revenue(_order_revenue(Silver(spark, sf_dir))))


@query("revenue_by_region")
def revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer revenue rolled up by region and state with subtotals."""
    s = Silver(spark, sf_dir)
    customers_mart = gold.customer_revenue(s.customers, _order_revenue(s))
    return finalize(metrics.revenue_by_region(customers_mart, adapter.states(spark, sf_dir)))


@query("top_products_by_category")
def top_products_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top three products by revenue in each category."""
    return finalize(metrics.top_products_by_category(_product_revenue(Silver(spark, sf_dir)), 3))


@query("top_customers")
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten customers with the most revenue (ties by id)."""
    s = Silver(spark, sf_dir)
    best = gold.customer_revenue(s.customers, _order_revenue(s)).orderBy(F.desc("customer_revenue"), "customer_id")
    return finalize(best.limit(10).select("customer_id", "full_name", "customer_revenue", "order_count"))


@query("customer_revenue_rank")
def customer_revenue_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's place by revenue, overall and within the state (ties by id)."""
    s = Silver(spark, sf_dir)
    order = [F.desc_nulls_last("customer_revenue"), F.asc("customer_id")]
    mart = gold.customer_revenue(s.customers, _order_revenue(s)).select("customer_id", "state", "customer_revenue")
    overall = global_rank(mart, order, out="revenue_rank")
    return finalize(global_rank(overall, order, ["state"], out="state_rank"))


@query("fact_order_items")
def fact_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-grain fact with order, customer, region and product columns."""
    s = Silver(spark, sf_dir)
    hot = {
        "customer_id": s.hot("orders", "customer_id"),
        "order_id": s.hot("order_items", "order_id"),
        "product_id": s.hot("order_items", "product_id"),
    }
    return finalize(
        metrics.fact_order_items(s.order_items, s.orders, s.customers, s.products, adapter.states(spark, sf_dir), hot)
    )


# ---------------------------------------------------------------- ingestion, sinks, upsert, history

def _ingest_csv(spark: SparkSession, sf_dir: str, names: list[str], blank_ids: bool = False) -> str:
    """Export tables as CSV sources with text ids, ingest them; returns the raw layer's folder."""
    root = scratch_path(spark, "csv")
    for n in names:
        csv_files.write_csv(adapter.source_rows(spark, sf_dir, n, blank_ids), f"{root}/source/{n}.csv")
    if set(names) == set(DATASETS):
        csv_files.ingest_all_datasets(spark, f"{root}/source", f"{root}/raw", DEFAULT_BATCH_ID)
    else:
        for n in names:
            csv_files.ingest_dataset(spark, n, f"{root}/source", f"{root}/raw", DEFAULT_BATCH_ID)
    return f"{root}/raw"


def _csv_roundtrip(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(spark.read.parquet(f"{_ingest_csv(spark, sf_dir, [name])}/{name}"))

    return run


query("bronze_roundtrip_customers")(_csv_roundtrip("customers"))
query("bronze_roundtrip_items")(_csv_roundtrip("order_items"))

# (dataset, parent id, a text of the row) shown by bronze_ingest_all beside the row's own id
_INGESTED = (
    ("customers", None, "email"),
    ("products", None, "product_name"),
    ("orders", "customer_id", "order_status"),
    ("order_items", "order_id", "product_id"),
    ("payments", "order_id", "payment_method"),
    ("shipments", "order_id", "delivery_status"),
)


@query("bronze_ingest_all")
def bronze_ingest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six tables from CSV sources with text ids: every row's id, parent id and one text."""
    raw = _ingest_csv(spark, sf_dir, list(DATASETS))
    parts = [
        spark.read.parquet(f"{raw}/{n}").select(
            F.lit(n).alias("dataset"),
            F.col(DATASETS[n].key).alias("record_id"),
            (F.col(parent) if parent else F.lit(None).cast("string")).alias("parent_id"),
            F.col(text).alias("detail"),
        )
        for n, parent, text in _INGESTED
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("rejected_blank_ids")
def rejected_blank_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and order lines from CSV sources with blank ids, rejected with every rule they break."""
    raw = _ingest_csv(spark, sf_dir, ["customers", "order_items"], blank_ids=True)
    parts = []
    for name, column in (("customers", "full_name"), ("order_items", "order_item_id")):
        _, rejected = quality.split_by_quality(spark.read.parquet(f"{raw}/{name}"), name, with_failed_rules=True)
        parts.append(
            rejected.select(
                F.lit(name).alias("dataset"),
                F.col(column).alias("record"),
                F.array_join(quality.FAILED_RULES, ",").alias("failed_rules"),
            )
        )
    return parts[0].unionByName(parts[1])


@query("display_ids")
def display_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-padded text ids of all products."""
    return read_table(spark, sf_dir, "part").select("p_partkey", display_id("PROD-", "p_partkey", 6).alias("display_id"))


@query("batch_ids")
def batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per batch id, the id being made from the event's time."""
    events_ = read_table(spark, sf_dir, "events")
    return events_.groupBy(batch_id_of("ts").alias("batch_id")).agg(F.count(F.lit(1)).alias("n"))


@query("parsed_quantities")
def parsed_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities exported as text, some of them not numbers, parsed back (NULL where that fails)."""
    items = raw_table(spark, sf_dir, "order_items")
    text = F.when(F.col("quantity") <= 0, F.lit("n/a")).otherwise(F.col("quantity").cast("string"))
    texts = items.select("order_item_id", text.alias("quantity_text"))
    return texts.withColumn("quantity", F.col("quantity_text").try_cast("int"))


@query("strict_ingest_quarantine")
def strict_ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose quantity is not a number are quarantined, the rest loaded: every line and its outcome."""
    root = scratch_path(spark, "strict")
    items = adapter.source_rows(spark, sf_dir, "order_items")
    text = items.withColumn(
        "quantity", F.when(F.col("quantity") <= 0, F.lit("n/a")).otherwise(F.col("quantity").cast("string"))
    )
    csv_files.write_csv(text, f"{root}/source/order_items.csv")
    out = f"{root}/raw/order_items"
    csv_files.strict_ingest(
        spark, f"{root}/source/order_items.csv", DATASETS["order_items"].source_schema, out
    )
    return spark.read.parquet(out).select(
        F.col("load_status").alias("outcome"), "order_item_id", "order_id", "product_id", "quantity"
    )


SCHEMA_CHANGE_AT = "1998-01-01"  # orders from this date on arrive with one more column


@query("schema_evolution_read")
def schema_evolution_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of orders, the second with an added column, read as one table."""
    root = scratch_path(spark, "evolution")
    o = read_table(spark, sf_dir, "orders")
    orders = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        adapter.order_status(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"),
    )
    newer = F.coalesce(F.col("order_timestamp") >= F.lit(SCHEMA_CHANGE_AT).cast("timestamp_ntz"), F.lit(False))
    write_table(orders.where(~newer).drop("order_priority"), f"{root}/orders/load=1")
    write_table(orders.where(newer), f"{root}/orders/load=2")
    return evolution.read_evolving(spark, f"{root}/orders")


def _customer_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(version 1 of the customers, changes of version 2)."""
    s = Silver(spark, sf_dir)
    valid, rejected = s.split("customers")
    cols = ["customer_id", "full_name", "email", "state"]
    base = valid.select(*cols, F.lit(1).alias("version"))
    repaired = rejected.select(
        "customer_id",
        "full_name",
        F.concat(F.lit("c"), F.col("customer_id").cast("string"), F.lit("@fixed.example.com")).alias("email"),
        "state",
        F.lit(2).alias("version"),
        F.lit(False).alias("deleted"),
    )
    orders_mart = _order_revenue(s)
    inactive = base.join(checks.keys_of(orders_mart, "customer_id"), "customer_id", "left_anti").select(
        *cols, F.lit(2).alias("version"), F.lit(True).alias("deleted")
    )
    return base, repaired.unionByName(inactive)


@query("upsert_customers")
def upsert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 2 of the customers: repaired e-mails of rejected rows are
    upserted, customers without any eligible order are deleted."""
    root = scratch_path(spark, "upsert")
    merged = upsert(*_customer_changes(spark, sf_dir), "customer_id", "version", "deleted")
    write_table(merged, f"{root}/customers/v2")
    return spark.read.parquet(f"{root}/customers/v2")


TABLE_BUCKETS = 16  # of the versioned tables below


@query("upsert_customer_versions")
def upsert_customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers before and after the same upsert, from a table that rewrites touched buckets only."""
    table = VersionedTable(spark, scratch_path(spark, "versioned-customers"), "customer_id", TABLE_BUCKETS)
    base, changes = _customer_changes(spark, sf_dir)
    first = table.create(base)
    second = table.upsert(changes, "version", "deleted")
    return (
        table.read(first).withColumn("table_version", F.lit(first).cast("long"))
        .unionByName(table.read(second).withColumn("table_version", F.lit(second).cast("long")))
    )


@query("upsert_customer_changes")
def upsert_customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What that upsert changed: rows gone (-1) and rows new (1), read from the buckets that differ."""
    table = VersionedTable(spark, scratch_path(spark, "versioned-customers"), "customer_id", TABLE_BUCKETS)
    base, changes = _customer_changes(spark, sf_dir)
    versions = table.create(base), table.upsert(changes, "version", "deleted")
    return table.changes(*versions).withColumnRenamed("_sign", "change")


def _validated_once(s: Silver, name: str) -> DataFrame:
    """What the marts read of a validated table, deduplicated once for all batches that are taken from it."""
    columns = {"orders": incremental.ORDER_COLUMNS, "order_items": incremental.LINE_COLUMNS}[name]
    ds, valid = DATASETS[name], quality.split_by_quality(s.raw(name), name)[0]
    order = list(ds.survivor_order)
    while order[-1] not in columns:  # rows that differ in it alone are the same to the marts
        order.pop()
    valid = valid.select(*dict.fromkeys((ds.key, *columns, *order)))
    return staged(layers.dedup_stored(valid, s.raw(name), name, ds.key, scratch_path(s.spark, "hot")).select(*columns))


def _corrected_load(spark: SparkSession, sf_dir: str) -> tuple[incremental.MartTables, Silver]:
    """Marts after two batches: a first load with orders missing, with a wrong status or with half
    their lines, and a second one that brings those orders whole."""
    s = Silver(spark, sf_dir)
    orders, order_items = _validated_once(s, "orders"), _validated_once(s, "order_items")
    part = F.col("order_id") % 10
    again = part.isin(3, 4, 5)
    early = orders.where(~F.coalesce(part == 3, F.lit(False))).withColumn(
        "order_status", F.when(part == 4, F.lit("processing")).otherwise(F.col("order_status"))
    )
    half = F.coalesce(part == 3, F.lit(False)) | F.coalesce((part == 5) & (F.col("product_id") % 2 == 0), F.lit(False))
    tables = incremental.MartTables.at(spark, scratch_path(spark, "incremental"), TABLE_BUCKETS)
    incremental.load(tables, early, order_items.where(~half), s.customers)
    incremental.refresh(tables, orders.where(again), order_items.where(again), s.customers)
    return tables, s


@query("incremental_order_revenue")
def incremental_order_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order mart after two batches, kept up to date without a rebuild."""
    tables, _ = _corrected_load(spark, sf_dir)
    return finalize(incremental.order_mart(tables))


@query("incremental_product_revenue")
def incremental_product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product mart after two batches, kept up to date from signed deltas."""
    tables, s = _corrected_load(spark, sf_dir)
    return finalize(incremental.product_mart(tables, s.products))


@query("active_customers_by_period")
def active_customers_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different customers per month and per year of the order mart, both from the months' bitmaps."""
    orders = _order_revenue(Silver(spark, sf_dir)).withColumn("month", F.date_trunc("month", "order_timestamp").cast("date"))
    path = scratch_path(spark, "active-bitmaps")
    write_table(incremental.active_bitmaps(orders, "customer_id", ["month"]), path)
    months = spark.read.parquet(path)
    years = months.withColumn("month", F.trunc("month", "year"))
    return (
        incremental.merged_count(months, ["month"], "customers").withColumn("period", F.lit("month"))
        .unionByName(incremental.merged_count(years, ["month"], "customers").withColumn("period", F.lit("year")))
        .withColumnRenamed("month", "first_day")
    )


@query("column_mapping_read")
def column_mapping_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of orders between which columns are renamed, widened, moved, dropped and added,
    read as one table by field id."""
    from pyspark.sql.types import DoubleType, LongType, StringType

    o = read_table(spark, sf_dir, "orders")
    table = evolution.MappedTable(spark, scratch_path(spark, "mapped-orders"))
    first = o.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").cast("int").alias("customer"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("note"),
    )
    load = F.pmod(F.col("o_orderkey"), F.lit(3))
    table.create(first.schema)
    table.append(first.where(F.pmod("order_id", F.lit(3)) == 0), "1")
    table.evolve(
        rename={"customer": "customer_id"}, widen={"customer": LongType()}, order=["customer_id", "order_id", "status", "note"]
    )
    second = o.where(load == 1).select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("note"),
    )
    table.append(second, "2")
    # the old note goes, and a new column takes its name
    table.evolve(rename={"status": "order_status"}, drop=["note"])
    table.evolve(add={"total_price": DoubleType(), "note": StringType()})
    third = o.where(load == 2).select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_price"), F.lit("third").alias("note"),
    )
    table.append(third, "3")
    return table.read()


@query("drift_gate")
def drift_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches of lines, the last with raised prices, gated on each batch's distance from those before."""
    batch = F.pmod(F.col("order_id"), F.lit(4)).cast("int")
    lines = Silver(spark, sf_dir).raw("order_items").select(batch.alias("batch"), "quantity", F.col("unit_price"))
    raised = F.when(F.col("batch") == 3, F.col("unit_price") * 1.5).otherwise(F.col("unit_price"))
    path = scratch_path(spark, "profiles")
    write_table(drift.profile(lines.withColumn("unit_price", raised), "batch", ["quantity", "unit_price"]), path)
    gated = drift.drift_gate(spark.read.parquet(path), "batch", MAX_DRIFT)
    return gated.select("batch", "column", "rows", "nulls", "passed")


MAX_DRIFT = 0.1  # fixed gate: no decile may move by more than a tenth of the rows


@query("unique_lines_gate")
def unique_lines_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness of the line id, per batch of lines."""
    lines = Silver(spark, sf_dir).raw("order_items").withColumn("batch", F.pmod(F.col("order_id"), F.lit(4)).cast("int"))
    return drift.repeated_keys(lines, "batch", "order_item_id")


@query("clustered_line_ranges")
def clustered_line_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a range of products and ship dates, from a table clustered over both."""
    path = scratch_path(spark, "clustered-lines")
    lines = Silver(spark, sf_dir).order_items
    by = {"product_id": F.col("product_id"), "ship_date": F.unix_date(F.col("ship_date").cast("date"))}
    write_clustered(lines, path, by, bloom=["order_id"])
    found = spark.read.parquet(path).where(
        "product_id between 100 and 299 and ship_date >= timestamp_ntz'1996-01-01' and ship_date < timestamp_ntz'1998-01-01'"
    )
    return finalize(found.select("order_item_id", "order_id", "product_id", "ship_date", "quantity", "line_amount"))


@query("load_times")
def load_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every raw table, and how many carry a load time between the start and the end of their load."""
    root = scratch_path(spark, "load-times")
    out = None
    for name in DATASETS:
        started = spark.range(1).select(F.current_timestamp()).first()[0]
        write_table(raw_table(spark, sf_dir, name).select("_ingestion_timestamp"), f"{root}/{name}")
        ended = spark.range(1).select(F.current_timestamp()).first()[0]
        rows = spark.read.parquet(f"{root}/{name}").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("_ingestion_timestamp").between(F.lit(started), F.lit(ended))).alias("in_time"),
        )
        rows = rows.select(F.lit(name).alias("dataset"), "rows", "in_time")
        out = rows if out is None else out.unionByName(rows)
    return out


# batches of the customer dimension: (day, customers it changes, the state they move by)
CUSTOMER_BATCHES = (("1995-01-01", 1, 0), ("1997-03-15", 3, 1), ("1998-01-01", 5, 2), ("1999-10-01", 7, 3))


def _customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by batch: each batch brings the customers whose id its number divides, in another segment."""
    root = scratch_path(spark, "customer-history")
    customers = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )
    for k, (day, every, step) in enumerate(CUSTOMER_BATCHES):
        moved = F.when(F.lit(step) == 0, F.col("segment")).otherwise(F.concat("segment", F.lit(f"-{step}")))
        batch = customers.where(F.col("customer_id") % every == 0).withColumn("segment", moved)
        batch = batch.withColumn("loaded_at", F.lit(day).cast("timestamp_ntz")).withColumn("batch", F.lit(k))
        append_partition(batch, root, "batch")
    return spark.read.parquet(root)


@query("customer_intervals")
def customer_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of a customer with the time it was valid, from four batches."""
    return intervals(_customer_history(spark, sf_dir), "customer_id", "loaded_at", ["segment"])


@query("orders_as_of_customer")
def orders_as_of_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible orders with the customer's segment at the time of the order."""
    versions = intervals(_customer_history(spark, sf_dir), "customer_id", "loaded_at", ["segment"])
    orders = _order_revenue(Silver(spark, sf_dir)).select("order_id", "customer_id", "order_timestamp", "order_revenue")
    month = F.date_trunc("month", "_at")
    return finalize(
        asof_join(orders, versions, "customer_id", "order_timestamp", "valid_from", ["segment", "valid_from"], month, "valid_to")
    )


@query("history_append")
def history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order status by batch: a first load, and a second one after open orders were shipped,
    which is re-run and replaces only its own partition."""
    root = scratch_path(spark, "history")
    first = raw_table(spark, sf_dir, "orders").select("order_id", "order_status")
    shipped = F.when(F.col("order_status") == "processing", F.lit("shipped")).otherwise(F.col("order_status"))
    second = first.withColumn("order_status", shipped)
    for batch, rows in (("batch-0001", first), ("batch-0002", first), ("batch-0002", second)):
        append_partition(rows.withColumn("batch_id", F.lit(batch)), f"{root}/orders", "batch_id")
    return spark.read.parquet(f"{root}/orders").select("batch_id", "order_id", "order_status")


def _new_table(spark: SparkSession, name: str) -> str:
    catalog.create_schema(spark, "strata_catalog", f"{scratch_root(spark)}/strata/catalog")
    return f"strata_catalog.{name}_{uuid.uuid4().hex[:12]}"


@query("catalog_roundtrip")
def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customers written over an older version of a catalog table and read back."""
    table = _new_table(spark, "customers")
    customers = raw_table(spark, sf_dir, "customers").drop(*UNSTABLE)
    catalog.save_as_table(customers.withColumn("email", F.lit(None).cast("string")), table)
    catalog.save_as_table(customers, table)
    return finalize(catalog.read_table(spark, table))


@query("catalog_replace_schema")
def catalog_replace_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table of customers overwritten by products: rows and columns are the new ones."""
    table = _new_table(spark, "replaced")
    for name in ("customers", "products"):
        catalog.save_as_table(raw_table(spark, sf_dir, name).drop(*UNSTABLE), table)
    return finalize(catalog.read_table(spark, table))


# ---------------------------------------------------------------- quality gates and the on-disk run

MIN_QUALITY_RATE = 0.95  # fixed gate: at least 95% of a batch must survive validation


@query("quality_gate")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality metrics with a pass/fail flag against the fixed minimum rate."""
    return quality.quality_gate(quality_metrics(spark, sf_dir), MIN_QUALITY_RATE)


@query("rule_failures")
def rule_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures and failure rate per quality rule."""
    parts = [quality.rule_failures(raw_table(spark, sf_dir, n), n) for n in quality.REASONS]
    return parts[0].unionByName(parts[1])


@query("rejected_order_items_rules")
def rejected_order_items_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected order lines with every rule they break (comma-separated, rule order)."""
    raw = Silver(spark, sf_dir).raw("order_items")
    _, rejected = quality.split_by_quality(raw, "order_items", with_failed_rules=True)
    return rejected.select(
        "order_item_id",
        quality.REASON,
        F.array_join(F.col(quality.FAILED_RULES), ",").alias("failed_rules"),
    )


@query("layer_run_counts")
def layer_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per layer and dataset of an on-disk run, counted from the files."""
    return layers.written_counts(spark, _on_disk_run(spark, sf_dir))


@query("run_log")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and written per layer and dataset, as an on-disk run has logged them."""
    log = spark.read.parquet(_on_disk_run(spark, sf_dir).run_log)
    return log.select("layer", "dataset", "batch_id", "rows_in", "rows")


# ---------------------------------------------------------------- streaming


def _event_source(spark: SparkSession, sf_dir: str, copies: int, files: int) -> str:
    """A landing folder with ``copies`` identical copies of the events table (feeds duplicates),
    each in ``files`` files that are not ordered in time."""
    land = scratch_path(spark, "events-landing")
    events = read_table(spark, sf_dir, "events")
    for i in range(copies):
        events.repartition(files, "event_id").write.mode("overwrite").parquet(f"{land}/part={i}")
    return land


def _events_stream_source(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(folder, file glob) to stream the events table from, whether it is stored
    as one file or as a folder of files."""
    path = table_path(sf_dir, "events")
    first = read_table(spark, sf_dir, "events").select(F.input_file_name()).limit(1).collect()
    if first and not first[0][0].endswith("/events.parquet"):
        return path, "*.parquet"
    return sf_dir, "events.parquet"


@query("stream_ingest_events")
def stream_ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events after a file-stream ingestion with a per-epoch split."""
    root = scratch_path(spark, "stream-ingest")
    folder, glob = _events_stream_source(spark, sf_dir)
    events.ingest(spark, folder, f"{root}/out", f"{root}/checkpoint", DEFAULT_BATCH_ID, file_glob=glob)
    return finalize(events.read_ingested(spark, f"{root}/out", "valid"))


@query("stream_dedup_events")
def stream_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events fed twice through a stream of four micro-batches, each kept once."""
    root = scratch_path(spark, "stream-dedup")
    source = _event_source(spark, sf_dir, copies=2, files=2)
    events.dedup(spark, source, f"{root}/out", f"{root}/checkpoint", max_files=1)
    return events.read_deduplicated(spark, f"{root}/out")


@query("stream_daily_counts")
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per UTC day and type from a stream (complete mode)."""
    root = scratch_path(spark, "stream-daily")
    folder, glob = _events_stream_source(spark, sf_dir)
    events.daily_counts(spark, folder, f"{root}/out", f"{root}/checkpoint", file_glob=glob)
    return spark.read.parquet(f"{root}/out")


@query("stream_closed_days")
def stream_closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per UTC day and type of the days that the watermark has closed (append mode)."""
    root = scratch_path(spark, "stream-closed")
    folder, glob = _events_stream_source(spark, sf_dir)
    events.daily_counts(spark, folder, f"{root}/out", f"{root}/checkpoint", file_glob=glob, mode="append")
    return spark.read.parquet(f"{root}/out")


#: Last day of each delivery but the last; every seventh event arrives one delivery later.
DELIVERY_ENDS = ("2024-01-08", "2024-01-15", "2024-01-22")
FILES_PER_DELIVERY = 2


def _event_deliveries(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder where the events arrive in four deliveries, some of them a delivery late."""
    land = scratch_path(spark, "events-deliveries")
    rows = read_table(spark, sf_dir, "events")
    number = F.lit(0)
    for end in DELIVERY_ENDS:
        number = number + F.coalesce(F.col("ts") >= F.lit(end).cast("timestamp_ntz"), F.lit(False)).cast("int")
    stray = F.coalesce(F.col("event_id") % 7 == 0, F.lit(False)).cast("int")
    rows = rows.withColumn("_delivery", F.least(number + stray, F.lit(len(DELIVERY_ENDS))))
    for k in range(len(DELIVERY_ENDS) + 1):  # files are streamed in the order they were written
        part = rows.where(F.col("_delivery") == k).drop("_delivery").repartition(FILES_PER_DELIVERY)
        part.write.parquet(f"{land}/delivery={k}")
    return land


def _accounted(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "stream-accounted")
    source = _event_deliveries(spark, sf_dir)
    events.accounted_days(spark, source, f"{root}/out", f"{root}/checkpoint", max_files=FILES_PER_DELIVERY)
    return f"{root}/out"


@query("stream_run_log")
def stream_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per epoch of the accounted stream: rows in = counted + late + undated, and the days it closed."""
    log = events.read_log(spark, _accounted(spark, sf_dir))
    return log.select("epoch", "rows_in", "counted", "late", "undated", "days_closed")


@query("stream_late_rows")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrived after their day was closed, from the side output."""
    late = events.read_late(spark, _accounted(spark, sf_dir))
    return late.select("epoch", "event_id", "ts", "user_id", "event_type", "value")
