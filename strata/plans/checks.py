"""Integrity, reconciliation and layer checks, as DataFrames of (check_name, value).

Checks read each table once and are sums over keys or rows; a key that holds
many rows becomes one row per task before any shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import StringType

from strata.functions.predicates import is_missing
from strata.plans.gold import COMMERCIAL_STATUSES

TEXT = StringType()


def measures(df: DataFrame, named: dict[str, Column], value_type: str = "bigint") -> DataFrame:
    """All measures of one frame in a single aggregate (one scan), stacked as
    (check_name, value) rows."""
    names = list(named)
    row = df.agg(*[named[n].cast(value_type).alias(f"_m{i}") for i, n in enumerate(names)])
    stacked = F.explode(
        F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"_m{i}").alias("value")) for i, n in enumerate(names)])
    )
    return row.select(stacked.alias("_s")).select("_s.check_name", "_s.value")


def _one(df: DataFrame, name: str, value: Column) -> DataFrame:
    return measures(df, {name: value})


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def keys_of(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys: the right side of a semi/anti join with one row per key.

    The partial aggregation collapses a key repeated many times before the
    shuffle, and the join reuses the aggregate's partitioning.
    """
    return df.select(key).distinct()


# (dataset, the keys its rows link by); the first key counts the table's rows
_LINKS = (
    ("customers", ("customer_id",)),
    ("products", ("product_id",)),
    ("orders", ("order_id", "customer_id")),
    ("order_items", ("order_id", "product_id")),
    ("payments", ("order_id",)),
    ("shipments", ("order_id",)),
)


def integrity_report(raw: dict[str, DataFrame]) -> DataFrame:
    """Row counts, referential orphans and injected-fault counts of the raw tables.

    Every table is read once: each row becomes one entry per key it links by,
    the entries of all tables are summed per key (partial sums first, so a hot
    key crosses the shuffle as one row per task), and the checks follow from the
    sums of each key. A NULL key is an orphan: it has no parent row.
    """
    flags = {
        "customers": is_missing("email", TEXT),
        "orders": F.coalesce(F.col("order_status") == "cancelled", F.lit(False)),
        "order_items": F.coalesce(F.col("quantity") <= 0, F.lit(True)),
    }
    entries = []
    for name, keys in _LINKS:
        links = [
            F.struct(
                F.lit(k).alias("kind"), F.col(k).cast("string").alias("key"), F.lit(i == 0).alias("counts_row")
            )
            for i, k in enumerate(keys)
        ]
        entries.append(
            raw[name]
            .select(flags.get(name, F.lit(False)).alias("flag"), F.explode(F.array(*links)).alias("link"))
            .select("link.*", F.lit(name).alias("tag"), "flag")
        )
    names = [n for n, _ in _LINKS]
    per_key = _union(entries).groupBy("kind", "key").agg(
        *[F.count_if(F.col("tag") == n).alias(n) for n in names],
        *[F.count_if((F.col("tag") == n) & F.col("counts_row")).alias(f"{n}_rows") for n in names],
        *[
            F.count_if((F.col("tag") == n) & F.col("counts_row") & F.col("flag")).alias(f"{n}_flagged")
            for n in flags
        ],
    )

    def sum_where(kind: str, condition: Column, value: str) -> Column:
        found = (F.col("kind") == kind) & condition
        return F.coalesce(F.sum(F.when(found, F.col(value))), F.lit(0))

    def without(parent: str) -> Column:
        return F.col("key").isNull() | (F.col(parent) == 0)

    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return measures(
        per_key,
        {f"{n}_rows": total(f"{n}_rows") for n in names}
        | {
            "blank_customer_emails": total("customers_flagged"),
            "cancelled_orders": total("orders_flagged"),
            "items_non_positive_quantity": total("order_items_flagged"),
            "orders_without_customer": sum_where("customer_id", without("customers"), "orders"),
            "items_without_order": sum_where("order_id", without("orders"), "order_items"),
            "items_without_product": sum_where("product_id", without("products"), "order_items"),
            "payments_without_order": sum_where("order_id", without("orders"), "payments"),
            "shipments_without_order": sum_where("order_id", without("orders"), "shipments"),
            "cancelled_with_shipment": sum_where(
                "order_id", F.col("key").isNotNull() & (F.col("shipments") > 0), "orders_flagged"
            ),
            "orders_without_items": sum_where(
                "order_id", F.col("key").isNull() | (F.col("order_items") == 0), "orders"
            ),
        },
    )


def cancelled_with_items(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Order ids that are cancelled yet have lines (set intersection)."""
    cancelled = orders.where(F.col("order_status") == "cancelled").select("order_id")
    return cancelled.intersect(keys_of(order_items, "order_id"))


def reconcile(
    frames: dict[str, tuple[DataFrame, dict[str, Column]]],
    pairs: list[tuple[str, str, str]],
    tolerance: float = 0.0,
) -> DataFrame:
    """Compare measures that should agree: one row per (check_name, left, right).

    ``frames`` maps a frame label to (frame, {measure: aggregate}); each frame
    is aggregated once. ``pairs`` are (check_name, left measure, right
    measure). The measure rows are folded into one row by a global aggregate,
    so no join is needed to put the two sides next to each other.
    """
    values = _union([measures(df, named, "double") for df, named in frames.values()])
    names = sorted({m for _, named in frames.values() for m in named})
    # one row, one column per measure (a handful of rows folded by a global aggregate)
    wide = values.agg(*[F.max(F.when(F.col("check_name") == n, F.col("value"))).alias(n) for n in names])
    stacked = F.explode(
        F.array(
            *[
                F.struct(F.lit(check).alias("check_name"), F.col(l).alias("left_value"), F.col(r).alias("right_value"))
                for check, l, r in pairs
            ]
        )
    )
    out = wide.select(stacked.alias("_p")).select("_p.*")
    ok = F.coalesce(F.abs(F.col("left_value") - F.col("right_value")) <= F.lit(tolerance), F.lit(False))
    return out.withColumn("ok", ok)


def fold(values: DataFrame, names: list[str], outputs: dict[str, Column]) -> DataFrame:
    """(check_name, value) rows named ``names`` -> one row with a column per
    name -> the ``outputs`` expressions over those columns, stacked as rows."""
    wide = values.agg(*[F.max(F.when(F.col("check_name") == n, F.col("value"))).alias(n) for n in names])
    stacked = F.explode(
        F.array(*[F.struct(F.lit(k).alias("check_name"), v.cast("bigint").alias("value")) for k, v in outputs.items()])
    )
    return wide.select(stacked.alias("_s")).select("_s.check_name", "_s.value")


def layer_checks(
    raw: dict[str, DataFrame],
    source_rows: dict[str, DataFrame],
    silver: dict[str, DataFrame],
    rejected: dict[str, DataFrame],
    order_revenue: DataFrame,
    customer_revenue: DataFrame,
    category_revenue: DataFrame,
    product_revenue: DataFrame,
) -> DataFrame:
    """Postconditions of each written layer; every value is a violation count (0 = pass).

    ``raw``, ``silver``, ``rejected`` and the marts are tables read back from
    storage, ``source_rows`` the sources they came from. Every table is
    aggregated once for all of its checks.
    """
    rows = F.count(F.lit(1))
    parts, conserved, outputs = [], [], {}
    for name, df in raw.items():
        kept = {f"{name}_silver": silver[name]} | ({f"{name}_rejected": rejected[name]} if name in rejected else {})
        conserved.append(
            measures(
                df,
                {
                    f"{name}_raw": rows,
                    f"{name}_batches": (F.min("_batch_id") != F.max("_batch_id")).cast("int"),
                    f"{name}_nowhere": F.count_if(is_missing("_source_file", TEXT)),
                },
            )
        )
        conserved += [measures(t, {n: rows}) for n, t in kept.items()]
        outputs[f"{name}_extra_batch_ids"] = F.coalesce(F.col(f"{name}_batches"), F.lit(0))
        outputs[f"{name}_missing_source_file"] = F.col(f"{name}_nowhere")
        if name in source_rows:
            conserved.append(measures(source_rows[name], {f"{name}_source": rows}))
            outputs[f"{name}_rows_lost_or_added"] = F.abs(F.col(f"{name}_raw") - F.col(f"{name}_source"))
        outputs[f"{name}_duplicates_dropped"] = F.col(f"{name}_raw") - sum(
            (F.col(n) for n in list(kept)[1:]), F.col(list(kept)[0])
        )
    names = [f"{n}_{k}" for n in raw for k in ("raw", "batches", "nowhere", "silver")]
    names += [f"{n}_rejected" for n in rejected] + [f"{n}_source" for n in source_rows]
    parts.append(fold(_union(conserved), names, outputs))
    parts.append(measures(silver["customers"], {"silver_blank_emails": F.count_if(is_missing("email", TEXT))}))
    parts.append(
        measures(
            silver["order_items"],
            {"silver_bad_quantity": F.count_if(F.coalesce(F.col("quantity") <= 0, F.lit(True)))},
        )
    )
    for name, df in rejected.items():
        parts.append(measures(df, {f"rejected_{name}_without_reason": F.count_if(is_missing("_dq_reason", TEXT))}))
    overlap = silver["customers"].select("customer_id").intersect(rejected["customers"].select("customer_id"))
    parts.append(_one(overlap, "customers_valid_and_rejected", rows))
    parts.append(
        measures(
            order_revenue,
            {
                "gold_status_outside_set": F.count_if(
                    ~F.coalesce(F.col("order_status").isin(*COMMERCIAL_STATUSES), F.lit(False))
                ),
                "gold_non_positive_revenue": F.count_if(F.coalesce(F.col("order_revenue") <= 0, F.lit(True))),
            },
        )
    )
    parts.append(measures(customer_revenue, {"gold_blank_emails": F.count_if(is_missing("email", TEXT))}))
    cats = silver["products"].select("category").distinct()
    mart_cats = category_revenue.select("category")
    parts.append(_one(cats.exceptAll(mart_cats), "categories_missing_in_mart", rows))
    parts.append(_one(mart_cats.exceptAll(cats), "categories_unknown_in_mart", rows))
    missing = (
        silver["products"]
        .select("product_id")
        .join(keys_of(product_revenue, "product_id"), "product_id", "left_anti")
    )
    parts.append(_one(missing, "products_missing_in_mart", rows))
    return _union(parts)
