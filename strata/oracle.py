"""Independent SQL (DuckDB dialect) for every registered query that SQL can express.

The driver registers its tables as views (region, nation, customer, ...).
``BASE`` repeats the table mapping and the validated layer in plain SQL;
each query appends its own CTEs and final SELECT. Money is summed as
DECIMAL and cast to DOUBLE in the final projection, as on the Spark side.
"""

from __future__ import annotations

BATCH = "'batch-0001'"

RAW = f"""
raw_customers AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS full_name,
         CASE WHEN c.c_custkey % 100 = 7 THEN ''
              WHEN c.c_custkey % 100 = 13 THEN '   '
              WHEN c.c_custkey % 100 = 19 THEN NULL
              ELSE 'c' || CAST(c.c_custkey AS VARCHAR) || '@example.com' END AS email,
         n.n_name AS state, CAST(NULL AS TIMESTAMP) AS created_at, {BATCH} AS _batch_id
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_retailprice AS unit_price, (p_partkey % 20 <> 0) AS active, {BATCH} AS _batch_id
  FROM part
),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_timestamp,
         CASE WHEN o_orderstatus = 'F' THEN 'completed'
              WHEN o_orderstatus = 'O' THEN 'shipped'
              WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'cancelled'
              WHEN o_orderstatus = 'P' THEN 'processing' END AS order_status,
         {BATCH} AS _batch_id
  FROM orders
),
raw_lines AS (
  SELECT *, ((l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 100 = 0) AS fault,
         CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS amount
  FROM lineitem
),
raw_order_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_item_id,
         l_orderkey AS order_id, l_partkey AS product_id,
         CASE WHEN fault THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
         CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price,
         CASE WHEN fault THEN CAST(0 AS DECIMAL(18,4)) ELSE amount END AS line_amount,
         l_suppkey AS supplier_id, l_shipdate AS ship_date,
         {BATCH} AS _batch_id
  FROM raw_lines
),
raw_payments AS (
  SELECT o.o_orderkey AS payment_id, o.o_orderkey AS order_id,
         CASE o.o_orderkey % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'pix'
              WHEN 2 THEN 'debit_card' ELSE 'bank_slip' END AS payment_method,
         t.payment_amount,
         o.o_orderdate + to_minutes(CAST(o.o_orderkey % 120 + 1 AS INTEGER)) AS payment_timestamp,
         {BATCH} AS _batch_id
  FROM orders o
  JOIN (SELECT l_orderkey, SUM(amount) AS payment_amount FROM raw_lines GROUP BY l_orderkey) t
    ON t.l_orderkey = o.o_orderkey
),
raw_shipments AS (
  SELECT order_id AS shipment_id, order_id,
         order_timestamp + to_hours(CAST(order_id % 69 + 4 AS INTEGER)) AS shipped_at,
         order_timestamp + to_hours(CAST(order_id % 69 + 4 AS INTEGER))
                         + to_days(CAST(order_id % 10 + 1 AS INTEGER)) AS delivered_at,
         'delivered' AS delivery_status, {BATCH} AS _batch_id
  FROM raw_orders WHERE order_status IS DISTINCT FROM 'cancelled'
)"""

FLAGS = """
flag_customers AS (
  SELECT *, COALESCE(customer_id IS NULL OR email IS NULL OR trim(email) = '', TRUE) AS bad
  FROM raw_customers
),
flag_order_items AS (
  SELECT *, COALESCE(order_item_id IS NULL OR trim(order_item_id) = '' OR order_id IS NULL
                     OR product_id IS NULL OR quantity IS NULL OR quantity <= 0
                     OR unit_price IS NULL OR unit_price < 0, TRUE) AS bad
  FROM raw_order_items
),
flag_products AS (SELECT *, FALSE AS bad FROM raw_products),
flag_orders AS (SELECT *, FALSE AS bad FROM raw_orders),
flag_payments AS (SELECT *, FALSE AS bad FROM raw_payments),
flag_shipments AS (SELECT *, FALSE AS bad FROM raw_shipments)"""

SILVER = """
silver_customers AS (
  SELECT * EXCLUDE (bad) FROM flag_customers WHERE NOT bad
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY full_name NULLS FIRST,
          email NULLS FIRST, state NULLS FIRST, created_at NULLS FIRST) = 1
),
silver_products AS (
  SELECT * EXCLUDE (bad) FROM flag_products WHERE NOT bad
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_name NULLS FIRST,
          category NULLS FIRST, unit_price NULLS FIRST, active NULLS FIRST) = 1
),
silver_orders AS (
  SELECT * EXCLUDE (bad) FROM flag_orders WHERE NOT bad
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id NULLS FIRST,
          order_timestamp NULLS FIRST, order_status NULLS FIRST) = 1
),
silver_order_items AS (
  SELECT * EXCLUDE (bad) FROM flag_order_items WHERE NOT bad
  QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY product_id NULLS FIRST,
          supplier_id NULLS FIRST, ship_date NULLS FIRST, quantity NULLS FIRST,
          line_amount NULLS FIRST, unit_price NULLS FIRST) = 1
),
silver_payments AS (
  SELECT * EXCLUDE (bad) FROM flag_payments WHERE NOT bad
  QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY order_id NULLS FIRST,
          payment_method NULLS FIRST, payment_amount NULLS FIRST, payment_timestamp NULLS FIRST) = 1
),
silver_shipments AS (
  SELECT * EXCLUDE (bad) FROM flag_shipments WHERE NOT bad
  QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY order_id NULLS FIRST,
          shipped_at NULLS FIRST, delivered_at NULLS FIRST, delivery_status NULLS FIRST) = 1
),
rejected_customers AS (
  SELECT * EXCLUDE (bad), 'missing_required_customer_fields' AS _dq_reason FROM flag_customers WHERE bad
),
rejected_order_items AS (
  SELECT * EXCLUDE (bad), 'invalid_order_item' AS _dq_reason FROM flag_order_items WHERE bad
)"""

GOLD = """
eligible_orders AS (
  SELECT o.* FROM silver_orders o
  WHERE o.order_status IN ('completed', 'shipped')
    AND o.customer_id IN (SELECT customer_id FROM silver_customers)
),
order_revenue AS (
  SELECT e.order_id, e.customer_id, e.order_timestamp, e.order_status,
         t.order_revenue, t.items_sold, t.distinct_products
  FROM eligible_orders e
  JOIN (SELECT order_id, SUM(line_amount) AS order_revenue,
               CAST(SUM(quantity) AS BIGINT) AS items_sold,
               COUNT(DISTINCT product_id) AS distinct_products
        FROM silver_order_items GROUP BY order_id) t ON t.order_id = e.order_id
),
product_revenue AS (
  SELECT p.product_id, p.product_name, p.category,
         CAST(SUM(i.quantity) AS BIGINT) AS units_sold,
         SUM(i.line_amount) AS product_revenue,
         COUNT(DISTINCT i.order_id) AS order_count
  FROM silver_order_items i
  JOIN silver_products p ON p.product_id = i.product_id
  WHERE i.order_id IN (SELECT order_id FROM eligible_orders)
  GROUP BY p.product_id, p.product_name, p.category
),
category_revenue AS (
  SELECT category, CAST(SUM(units_sold) AS BIGINT) AS units_sold,
         SUM(product_revenue) AS category_revenue,
         CAST(SUM(order_count) AS BIGINT) AS product_order_occurrences
  FROM product_revenue GROUP BY category
),
customer_revenue AS (
  SELECT c.customer_id, c.full_name, c.email, c.state,
         m.order_count, m.customer_revenue, m.average_order_value, m.items_purchased
  FROM silver_customers c
  JOIN (SELECT customer_id, COUNT(DISTINCT order_id) AS order_count,
               SUM(order_revenue) AS customer_revenue,
               CAST(SUM(order_revenue) AS DOUBLE) / COUNT(order_revenue) AS average_order_value,
               CAST(SUM(items_sold) AS BIGINT) AS items_purchased
        FROM order_revenue GROUP BY customer_id) m ON m.customer_id = c.customer_id
),
states AS (
  SELECT n.n_name AS state, r.r_name AS region
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
business_kpis AS (
  SELECT COUNT(DISTINCT order_id) AS total_orders,
         COUNT(DISTINCT customer_id) AS active_customers,
         SUM(order_revenue) AS total_revenue,
         CAST(SUM(order_revenue) AS DOUBLE) / NULLIF(COUNT(order_revenue), 0) AS average_order_value,
         CAST(SUM(items_sold) AS BIGINT) AS total_items_sold
  FROM order_revenue
)"""

PRELUDE = "WITH" + RAW + "," + FLAGS + "," + SILVER + "," + GOLD

SQL: dict[str, str] = {}


def sql(name: str, body: str, extra_ctes: str = "") -> None:
    prelude = PRELUDE + ("," + extra_ctes if extra_ctes else "")
    SQL[name] = prelude + "\n" + body


# validated layer
sql("silver_customers", "SELECT * FROM silver_customers")
sql("silver_products", "SELECT * FROM silver_products")
sql("silver_orders", "SELECT * FROM silver_orders")
sql("silver_order_items", "SELECT * REPLACE (CAST(line_amount AS DOUBLE) AS line_amount) FROM silver_order_items")
sql("silver_payments", "SELECT * REPLACE (CAST(payment_amount AS DOUBLE) AS payment_amount) FROM silver_payments")
sql("silver_shipments", "SELECT * FROM silver_shipments")
sql("rejected_customers", "SELECT * FROM rejected_customers")
sql(
    "rejected_order_items",
    "SELECT * REPLACE (CAST(line_amount AS DOUBLE) AS line_amount) FROM rejected_order_items",
)

_METRIC_PARTS = []
for _ds, _key in (
    ("customers", "customer_id"),
    ("products", "product_id"),
    ("orders", "order_id"),
    ("order_items", "order_item_id"),
    ("payments", "payment_id"),
    ("shipments", "shipment_id"),
):
    _METRIC_PARTS.append(
        f"""SELECT '{_ds}' AS dataset, input_records, valid_records, rejected_records,
       input_records - valid_records - rejected_records AS duplicate_records,
       CASE WHEN input_records = 0 THEN 0.0 ELSE CAST(valid_records AS DOUBLE) / input_records END AS quality_rate,
       {BATCH} AS batch_id
FROM (SELECT COUNT(*) AS input_records,
             COUNT(*) FILTER (WHERE bad) AS rejected_records,
             COUNT(DISTINCT {_key}) FILTER (WHERE NOT bad)
               + COALESCE(MAX(CASE WHEN NOT bad AND {_key} IS NULL THEN 1 ELSE 0 END), 0) AS valid_records
      FROM flag_{_ds})"""
    )
sql("quality_metrics", "\nUNION ALL\n".join(_METRIC_PARTS))

# marts
sql("eligible_orders", "SELECT * FROM eligible_orders")
sql("order_revenue", "SELECT * REPLACE (CAST(order_revenue AS DOUBLE) AS order_revenue) FROM order_revenue")
sql(
    "product_revenue",
    "SELECT * REPLACE (CAST(product_revenue AS DOUBLE) AS product_revenue) FROM product_revenue",
)
sql(
    "category_revenue",
    "SELECT * REPLACE (CAST(category_revenue AS DOUBLE) AS category_revenue) FROM category_revenue",
)
sql(
    "customer_revenue",
    "SELECT * REPLACE (CAST(customer_revenue AS DOUBLE) AS customer_revenue) FROM customer_revenue",
)
sql(
    "business_kpis",
    "SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) FROM business_kpis",
)
sql(
    "status_counts",
    "SELECT order_status, COUNT(*) AS n FROM silver_orders GROUP BY order_status ORDER BY order_status",
)

# checks and derived tables
_ROWS = "\nUNION ALL\n".join(
    f"SELECT '{n}_rows' AS check_name, CAST(COUNT(*) AS BIGINT) AS value FROM raw_{n}"
    for n in ("customers", "products", "orders", "order_items", "payments", "shipments")
)


def _orphans(name: str, child: str, parent: str, key: str) -> str:
    return (
        f"SELECT '{name}', CAST(COUNT(*) AS BIGINT) FROM {_BROKEN.get(child, 'raw_' + child)} x "
        f"WHERE NOT EXISTS (SELECT 1 FROM {_BROKEN.get(parent, 'raw_' + parent)} y WHERE y.{key} = x.{key})"
    )


def _lost(key: str, by: str) -> str:
    return f"CASE WHEN {by} % 100 = 3 THEN {key} + 1000000000000000 ELSE {key} END AS {key}"


_BROKEN = {n: f"broken_{n}" for n in ("orders", "order_items", "payments", "shipments")}
_BROKEN_CTES = f"""broken_orders AS (
  SELECT order_id, {_lost('customer_id', 'customer_id')},
         CASE WHEN order_id % 100 = 9 THEN 'cancelled' ELSE order_status END AS order_status
  FROM raw_orders
),
broken_order_items AS (
  SELECT {_lost('order_id', 'order_id')}, {_lost('product_id', 'product_id')}, quantity FROM raw_order_items
),
broken_payments AS (SELECT {_lost('order_id', 'payment_id')} FROM raw_payments),
broken_shipments AS (SELECT {_lost('order_id', 'shipment_id')} FROM raw_shipments)"""


sql(
    "integrity_report",
    "\nUNION ALL\n".join(
        [
            _ROWS,
            _orphans("orders_without_customer", "orders", "customers", "customer_id"),
            _orphans("items_without_order", "order_items", "orders", "order_id"),
            _orphans("items_without_product", "order_items", "products", "product_id"),
            _orphans("payments_without_order", "payments", "orders", "order_id"),
            _orphans("shipments_without_order", "shipments", "orders", "order_id"),
            "SELECT 'blank_customer_emails', COUNT(*) FILTER (WHERE email IS NULL OR trim(email) = '') FROM raw_customers",
            "SELECT 'items_non_positive_quantity', COUNT(*) FILTER (WHERE quantity IS NULL OR quantity <= 0) FROM raw_order_items",
            "SELECT 'cancelled_orders', COUNT(*) FROM broken_orders WHERE order_status = 'cancelled'",
            "SELECT 'cancelled_with_shipment', COUNT(*) FROM broken_orders o WHERE order_status = 'cancelled' "
            "AND EXISTS (SELECT 1 FROM broken_shipments s WHERE s.order_id = o.order_id)",
            "SELECT 'orders_without_items', COUNT(*) FROM broken_orders o "
            "WHERE NOT EXISTS (SELECT 1 FROM broken_order_items i WHERE i.order_id = o.order_id)",
        ]
    ),
    _BROKEN_CTES,
)
sql(
    "cancelled_with_items",
    "SELECT order_id FROM raw_orders WHERE order_status = 'cancelled' INTERSECT SELECT order_id FROM raw_order_items",
)


def _pair(name: str, left: str, right: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, l AS left_value, r AS right_value, "
        f"COALESCE(abs(l - r) <= 0.005, FALSE) AS ok "
        f"FROM (SELECT CAST(({left}) AS DOUBLE) AS l, CAST(({right}) AS DOUBLE) AS r)"
    )


sql(
    "reconcile_gold",
    "\nUNION ALL\n".join(
        [
            _pair(
                "active_customers_vs_customer_mart",
                "SELECT COUNT(DISTINCT customer_id) FROM order_revenue",
                "SELECT COUNT(*) FROM customer_revenue",
            ),
            _pair(
                "category_total_vs_kpi_total",
                "SELECT SUM(category_revenue) FROM category_revenue",
                "SELECT SUM(order_revenue) FROM order_revenue",
            ),
            _pair(
                "product_total_vs_category_total",
                "SELECT SUM(product_revenue) FROM product_revenue",
                "SELECT SUM(category_revenue) FROM category_revenue",
            ),
            _pair(
                "customer_total_vs_kpi_total",
                "SELECT SUM(customer_revenue) FROM customer_revenue",
                "SELECT SUM(order_revenue) FROM order_revenue",
            ),
            _pair(
                "items_sold_vs_units_sold",
                "SELECT SUM(items_sold) FROM order_revenue",
                "SELECT SUM(units_sold) FROM product_revenue",
            ),
        ]
    ),
)

_LAYER = [
    f"SELECT '{n}_rows_lost_or_added' AS check_name, "
    f"CAST(abs((SELECT COUNT(*) FROM raw_{n}) - (SELECT COUNT(*) FROM {src})) AS BIGINT) AS value"
    for n, src in (("customers", "customer"), ("products", "part"), ("orders", "orders"), ("order_items", "lineitem"))
]
for _n in ("customers", "products", "orders", "order_items", "payments", "shipments"):
    _LAYER.append(f"SELECT '{_n}_extra_batch_ids', CAST(greatest(COUNT(DISTINCT _batch_id) - 1, 0) AS BIGINT) FROM raw_{_n}")
    # every written raw row names its source file
    _LAYER.append(f"SELECT '{_n}_missing_source_file', CAST(0 AS BIGINT)")
    _rejects = f" - (SELECT COUNT(*) FROM rejected_{_n})" if _n in ("customers", "order_items") else ""
    _LAYER.append(
        f"SELECT '{_n}_duplicates_dropped', "
        f"CAST((SELECT COUNT(*) FROM raw_{_n}) - (SELECT COUNT(*) FROM silver_{_n}){_rejects} AS BIGINT)"
    )
_LAYER += [
    "SELECT 'silver_blank_emails', COUNT(*) FILTER (WHERE email IS NULL OR trim(email) = '') FROM silver_customers",
    "SELECT 'silver_bad_quantity', COUNT(*) FILTER (WHERE quantity IS NULL OR quantity <= 0) FROM silver_order_items",
    "SELECT 'rejected_customers_without_reason', COUNT(*) FILTER (WHERE _dq_reason IS NULL OR trim(_dq_reason) = '') "
    "FROM rejected_customers",
    "SELECT 'rejected_order_items_without_reason', COUNT(*) FILTER (WHERE _dq_reason IS NULL OR trim(_dq_reason) = '') "
    "FROM rejected_order_items",
    "SELECT 'customers_valid_and_rejected', COUNT(*) FROM "
    "(SELECT customer_id FROM silver_customers INTERSECT SELECT customer_id FROM rejected_customers)",
    "SELECT 'gold_status_outside_set', COUNT(*) FILTER (WHERE NOT COALESCE(order_status IN ('completed', 'shipped'), FALSE)) "
    "FROM order_revenue",
    "SELECT 'gold_non_positive_revenue', COUNT(*) FILTER (WHERE COALESCE(order_revenue <= 0, TRUE)) FROM order_revenue",
    "SELECT 'gold_blank_emails', COUNT(*) FILTER (WHERE email IS NULL OR trim(email) = '') FROM customer_revenue",
    "SELECT 'categories_missing_in_mart', COUNT(*) FROM "
    "(SELECT DISTINCT category FROM silver_products EXCEPT ALL SELECT category FROM category_revenue)",
    "SELECT 'categories_unknown_in_mart', COUNT(*) FROM "
    "(SELECT category FROM category_revenue EXCEPT ALL SELECT DISTINCT category FROM silver_products)",
    "SELECT 'products_missing_in_mart', COUNT(*) FROM silver_products p "
    "WHERE NOT EXISTS (SELECT 1 FROM product_revenue m WHERE m.product_id = p.product_id)",
]
sql("layer_checks", "\nUNION ALL\n".join(_LAYER))
sql("payments_derived", "SELECT * REPLACE (CAST(payment_amount AS DOUBLE) AS payment_amount) FROM raw_payments")
sql("shipments_derived", "SELECT * FROM raw_shipments")

# business metrics
sql(
    "delivery_performance",
    """SELECT delivery_status, CAST(date_trunc('month', shipped_at) AS DATE) AS ship_month,
       COUNT(*) AS shipments, AVG(d) AS avg_transit_days, CAST(MAX(d) AS INTEGER) AS max_transit_days,
       CAST(COUNT(*) FILTER (WHERE d <= 5) AS DOUBLE) / NULLIF(COUNT(d), 0) AS on_time_rate
FROM (SELECT *, datediff('day', shipped_at, delivered_at) AS d FROM silver_shipments)
GROUP BY 1, 2""",
)
sql(
    "cancellation_rate",
    """SELECT total_orders, cancelled_orders,
       CAST(cancelled_orders AS DOUBLE) / NULLIF(total_orders, 0) AS cancellation_rate
FROM (SELECT COUNT(*) AS total_orders, COUNT(*) FILTER (WHERE order_status = 'cancelled') AS cancelled_orders
      FROM silver_orders)""",
)
sql(
    "cancellation_by_month",
    """SELECT order_month, total_orders, cancelled_orders,
       CAST(cancelled_orders AS DOUBLE) / NULLIF(total_orders, 0) AS cancellation_rate
FROM (SELECT CAST(date_trunc('month', order_timestamp) AS DATE) AS order_month, COUNT(*) AS total_orders,
             COUNT(*) FILTER (WHERE order_status = 'cancelled') AS cancelled_orders
      FROM silver_orders GROUP BY 1)""",
)
sql(
    "customer_recurrence",
    """SELECT COUNT(*) AS active_customers, COUNT(*) FILTER (WHERE n >= 2) AS repeat_customers,
       CAST(COUNT(*) FILTER (WHERE n >= 2) AS DOUBLE) / NULLIF(COUNT(*), 0) AS repeat_rate
FROM (SELECT customer_id, COUNT(*) AS n FROM order_revenue GROUP BY customer_id)""",
)
sql(
    "customer_lifetime",
    """SELECT customer_id, MIN(order_timestamp) AS first_order_at, MAX(order_timestamp) AS last_order_at,
       COUNT(*) AS orders, CAST(SUM(order_revenue) AS DOUBLE) AS lifetime_revenue,
       CAST(datediff('day', MIN(order_timestamp), MAX(order_timestamp)) AS INTEGER) AS tenure_days
FROM order_revenue GROUP BY customer_id""",
)
sql(
    "customer_running_revenue",
    """SELECT customer_id, order_timestamp, order_id, CAST(order_revenue AS DOUBLE) AS order_revenue,
       CAST(SUM(order_revenue) OVER (PARTITION BY customer_id ORDER BY order_timestamp NULLS FIRST,
            order_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_revenue
FROM order_revenue""",
)
sql(
    "revenue_by_region",
    """SELECT s.region, c.state, CAST(GROUPING_ID(s.region, c.state) AS BIGINT) AS level, CAST(SUM(c.customer_revenue) AS DOUBLE) AS revenue,
       CAST(SUM(c.order_count) AS BIGINT) AS orders, COUNT(*) AS customers
FROM customer_revenue c LEFT JOIN states s ON s.state = c.state
GROUP BY ROLLUP (s.region, c.state)""",
)
sql(
    "top_products_by_category",
    """SELECT category, CAST(product_rank AS INTEGER) AS product_rank, product_id, product_name,
       CAST(product_revenue AS DOUBLE) AS product_revenue
FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY product_revenue DESC NULLS LAST,
             product_id ASC) AS product_rank FROM product_revenue)
WHERE product_rank <= 3""",
)
sql(
    "top_customers",
    """SELECT customer_id, full_name, CAST(customer_revenue AS DOUBLE) AS customer_revenue, order_count
FROM customer_revenue ORDER BY customer_revenue DESC NULLS LAST, customer_id LIMIT 10""",
)
sql(
    "customer_revenue_rank",
    """SELECT customer_id, state, CAST(customer_revenue AS DOUBLE) AS customer_revenue,
       row_number() OVER (ORDER BY customer_revenue DESC NULLS LAST, customer_id) AS revenue_rank,
       row_number() OVER (PARTITION BY state ORDER BY customer_revenue DESC NULLS LAST, customer_id) AS state_rank
FROM customer_revenue""",
)
sql(
    "fact_order_items",
    """SELECT i.order_item_id, i.order_id, i.product_id, i.quantity, CAST(i.line_amount AS DOUBLE) AS line_amount,
       o.customer_id, o.order_timestamp, o.order_status, o.state, o.region, p.product_name, p.category
FROM silver_order_items i
LEFT JOIN (SELECT o.order_id, o.customer_id, o.order_timestamp, o.order_status, c.state, st.region
           FROM silver_orders o
           LEFT JOIN silver_customers c ON c.customer_id = o.customer_id
           LEFT JOIN states st ON st.state = c.state) o ON o.order_id = i.order_id
LEFT JOIN silver_products p ON p.product_id = i.product_id""",
)

# ingestion, sinks, upsert, history
_IDS = {"customer_id": "CUST-", "product_id": "PROD-", "order_id": "ORD-", "payment_id": "PAY-", "shipment_id": "SHIP-"}


def _text(key: str, blank: str | None = None) -> str:
    """The text id of a CSV source; ``blank`` replaces it where the injected fault says so."""
    text = f"printf('{_IDS[key]}%06d', {key})"
    return f"CASE WHEN {key} % 100 = 37 THEN {blank} ELSE {text} END" if blank else text


sql(
    "bronze_roundtrip_customers",
    # an empty text field reads back from CSV as NULL; spaces are kept
    f"SELECT {_text('customer_id')} AS customer_id, full_name, NULLIF(email, '') AS email, state, created_at, _batch_id "
    "FROM raw_customers",
)
sql(
    "bronze_roundtrip_items",
    f"""SELECT order_item_id, {_text('order_id')} AS order_id, {_text('product_id')} AS product_id, quantity, unit_price,
       CAST(line_amount AS DOUBLE) AS line_amount, _batch_id
FROM raw_order_items""",
)
sql(
    "bronze_ingest_all",
    "\nUNION ALL\n".join(
        f"SELECT '{ds}' AS dataset, {own} AS record_id, {parent} AS parent_id, {detail} AS detail FROM raw_{ds}"
        for ds, own, parent, detail in (
            ("customers", _text("customer_id"), "CAST(NULL AS VARCHAR)", "NULLIF(email, '')"),
            ("products", _text("product_id"), "CAST(NULL AS VARCHAR)", "product_name"),
            ("orders", _text("order_id"), _text("customer_id"), "order_status"),
            ("order_items", "order_item_id", _text("order_id"), _text("product_id")),
            ("payments", _text("payment_id"), _text("order_id"), "payment_method"),
            ("shipments", _text("shipment_id"), _text("order_id"), "delivery_status"),
        )
    ),
)
sql(
    "rejected_blank_ids",
    f"""SELECT 'customers' AS dataset, full_name AS record,
       concat_ws(',', CASE WHEN trim({_text('customer_id', "'   '")}) = '' THEN 'customer_id_missing' END,
                      CASE WHEN email IS NULL OR trim(email) = '' THEN 'email_missing' END) AS failed_rules
FROM raw_customers WHERE trim({_text('customer_id', "'   '")}) = '' OR email IS NULL OR trim(email) = ''
UNION ALL
SELECT 'order_items', order_item_id,
       concat_ws(',', CASE WHEN {_text('order_id', "''")} = '' THEN 'order_id_missing' END,
                      CASE WHEN quantity IS NULL OR quantity <= 0 THEN 'quantity_not_positive' END,
                      CASE WHEN unit_price IS NULL OR unit_price < 0 THEN 'unit_price_negative' END)
FROM raw_order_items
WHERE {_text('order_id', "''")} = '' OR quantity IS NULL OR quantity <= 0 OR unit_price IS NULL OR unit_price < 0""",
)
SQL["display_ids"] = "SELECT p_partkey, printf('PROD-%06d', p_partkey) AS display_id FROM part"
SQL["batch_ids"] = "SELECT strftime(ts, '%Y%m%dT%H%M%SZ') AS batch_id, COUNT(*) AS n FROM events GROUP BY 1"
sql(
    "parsed_quantities",
    """SELECT order_item_id, quantity_text, TRY_CAST(quantity_text AS INTEGER) AS quantity
FROM (SELECT order_item_id, CASE WHEN quantity <= 0 THEN 'n/a' ELSE CAST(quantity AS VARCHAR) END AS quantity_text
      FROM raw_order_items)""",
)
sql(
    "strict_ingest_quarantine",
    f"""SELECT CASE WHEN quantity <= 0 THEN 'quarantined' ELSE 'loaded' END AS outcome, order_item_id,
       {_text('order_id')} AS order_id, {_text('product_id')} AS product_id,
       CASE WHEN quantity <= 0 THEN NULL ELSE quantity END AS quantity
FROM raw_order_items""",
)
sql(
    "schema_evolution_read",
    """SELECT o.order_id, o.customer_id, o.order_timestamp, o.order_status,
       CASE WHEN o.order_timestamp >= TIMESTAMP '1998-01-01' THEN d.o_orderpriority END AS order_priority,
       CASE WHEN o.order_timestamp >= TIMESTAMP '1998-01-01' THEN 2 ELSE 1 END AS load
FROM raw_orders o JOIN orders d ON d.o_orderkey = o.order_id""",
)
_VERSIONS = """base_customers AS (SELECT customer_id, full_name, email, state, 1 AS version FROM silver_customers),
changes AS (
  SELECT customer_id, full_name, 'c' || CAST(customer_id AS VARCHAR) || '@fixed.example.com' AS email, state,
         2 AS version, FALSE AS deleted
  FROM rejected_customers
  UNION ALL
  SELECT customer_id, full_name, email, state, 2, TRUE FROM base_customers b
  WHERE NOT EXISTS (SELECT 1 FROM order_revenue o WHERE o.customer_id = b.customer_id)
),
all_versions AS (
  SELECT *, FALSE AS deleted, 0 AS src FROM base_customers
  UNION ALL
  SELECT *, 1 AS src FROM changes
)"""
sql(
    "upsert_customers",
    """SELECT customer_id, full_name, email, state, version FROM all_versions
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY version DESC NULLS LAST, src DESC) = 1
    AND NOT COALESCE(deleted, FALSE)""",
    _VERSIONS,
)
_SECOND = """(SELECT customer_id, full_name, email, state, version FROM all_versions
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY version DESC NULLS LAST, src DESC) = 1
      AND NOT COALESCE(deleted, FALSE))"""
sql(
    "upsert_customer_versions",
    f"""SELECT *, CAST(1 AS BIGINT) AS table_version FROM base_customers
UNION ALL SELECT *, CAST(2 AS BIGINT) FROM {_SECOND}""",
    _VERSIONS,
)
sql(
    "upsert_customer_changes",
    f"""SELECT *, 1 AS change FROM (SELECT * FROM {_SECOND} EXCEPT ALL SELECT * FROM base_customers)
UNION ALL SELECT *, -1 FROM (SELECT * FROM base_customers EXCEPT ALL SELECT * FROM {_SECOND})""",
    _VERSIONS,
)
# kept up to date over two batches, the marts equal the ones built at once
sql("incremental_order_revenue", "SELECT * REPLACE (CAST(order_revenue AS DOUBLE) AS order_revenue) FROM order_revenue")
sql("incremental_product_revenue", "SELECT * REPLACE (CAST(product_revenue AS DOUBLE) AS product_revenue) FROM product_revenue")
sql(
    "active_customers_by_period",
    """SELECT CAST(date_trunc(p.period, order_timestamp) AS DATE) AS first_day, p.period, count(DISTINCT customer_id) AS customers
FROM order_revenue, (VALUES ('month'), ('year')) AS p(period) GROUP BY 1, 2""",
)
SQL["column_mapping_read"] = """SELECT CAST(o_custkey AS BIGINT) AS customer_id, o_orderkey AS order_id, o_orderstatus AS order_status,
       CASE WHEN o_orderkey % 3 = 2 THEN o_totalprice END AS total_price, CASE WHEN o_orderkey % 3 = 2 THEN 'third' END AS note
FROM orders"""
# exact deciles of a batch, and the share of earlier values up to each
sql(
    "drift_gate",
    """SELECT b.batch, b.col AS column, b.rows, b.nulls, coalesce(max(abs(e.rank - e.share)) <= 0.1, TRUE) AS passed
FROM (SELECT batch, col, count(*) AS rows, count(*) - count(v) AS nulls FROM drift_values GROUP BY 1, 2) b
LEFT JOIN (
  SELECT d.batch, d.col, d.share, avg(CASE WHEN x.v <= d.q THEN 1.0 ELSE 0.0 END) AS rank
  FROM (SELECT batch, col, share, quantile_disc(v, share) AS q
        FROM (SELECT batch, col, v FROM drift_values WHERE v IS NOT NULL),
             (VALUES (0.1), (0.2), (0.3), (0.4), (0.5), (0.6), (0.7), (0.8), (0.9)) AS s(share)
        GROUP BY batch, col, share) d
  JOIN drift_values x ON x.col = d.col AND x.batch < d.batch AND x.v IS NOT NULL
  GROUP BY 1, 2, 3
) e ON e.batch = b.batch AND e.col = b.col
GROUP BY 1, 2, 3, 4""".replace("quantile_disc(v, share)", "list_sort(list(v))[CAST(greatest(1, ceil(share * count(v))) AS BIGINT)]"),
    """drift_lines AS (
  SELECT CAST(order_id % 4 AS INTEGER) AS batch, CAST(quantity AS DOUBLE) AS quantity,
         CASE WHEN order_id % 4 = 3 THEN unit_price * 1.5 ELSE unit_price END AS price
  FROM raw_order_items
), drift_values AS (
  SELECT batch, 'quantity' AS col, quantity AS v FROM drift_lines UNION ALL SELECT batch, 'unit_price', price FROM drift_lines
)""",
)
sql(
    "unique_lines_gate",
    """SELECT batch, CAST(sum(n) AS BIGINT) AS rows,
       CAST(sum(CASE WHEN order_item_id IS NULL THEN n ELSE n - 1 END) AS BIGINT) AS repeated,
       sum(CASE WHEN order_item_id IS NULL THEN n ELSE n - 1 END) = 0 AS passed
FROM (SELECT CAST(order_id % 4 AS INTEGER) AS batch, order_item_id, count(*) AS n FROM raw_order_items GROUP BY 1, 2)
GROUP BY batch""",
)
sql(
    "clustered_line_ranges",
    """SELECT order_item_id, order_id, product_id, ship_date, quantity, CAST(line_amount AS DOUBLE) AS line_amount
FROM silver_order_items
WHERE product_id BETWEEN 100 AND 299 AND ship_date >= TIMESTAMP '1996-01-01' AND ship_date < TIMESTAMP '1998-01-01'""",
)
sql(
    "load_times",
    "\nUNION ALL ".join(
        f"SELECT '{n}' AS dataset, count(*) AS rows, count(*) AS in_time FROM raw_{n}"
        for n in ("customers", "products", "orders", "order_items", "payments", "shipments")
    ),
)
_HISTORY = """customer_history AS (
  SELECT c_custkey AS customer_id, c_mktsegment || CASE WHEN step > 0 THEN '-' || step ELSE '' END AS segment, CAST(day AS TIMESTAMP) AS valid_from
  FROM customer, (VALUES ('1995-01-01', 1, 0), ('1997-03-15', 3, 1), ('1998-01-01', 5, 2), ('1999-10-01', 7, 3)) AS b(day, every, step)
  WHERE c_custkey % every = 0
), customer_versions AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to FROM customer_history
)"""
sql("customer_intervals", "SELECT customer_id, segment, valid_from, valid_to FROM customer_versions", _HISTORY)
sql(
    "orders_as_of_customer",
    """SELECT o.order_id, o.customer_id, o.order_timestamp, CAST(o.order_revenue AS DOUBLE) AS order_revenue, v.segment, v.valid_from
FROM order_revenue o LEFT JOIN customer_versions v
  ON v.customer_id = o.customer_id AND v.valid_from <= o.order_timestamp AND (v.valid_to IS NULL OR v.valid_to > o.order_timestamp)""",
    _HISTORY,
)
sql(
    "history_append",
    """SELECT 'batch-0001' AS batch_id, order_id, order_status FROM raw_orders
UNION ALL
SELECT 'batch-0002', order_id, CASE WHEN order_status = 'processing' THEN 'shipped' ELSE order_status END FROM raw_orders""",
)
sql("catalog_roundtrip", "SELECT * FROM raw_customers")
sql("catalog_replace_schema", "SELECT * FROM raw_products")
sql(
    "written_order_revenue",
    "SELECT * REPLACE (CAST(order_revenue AS DOUBLE) AS order_revenue) FROM order_revenue",
)
sql("written_business_kpis", "SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) FROM business_kpis")

# quality gates and the on-disk run
_METRICS = "\nUNION ALL\n".join(_METRIC_PARTS)
sql("quality_gate", f"SELECT *, quality_rate >= 0.95 AS passed FROM ({_METRICS})")

_RULES = {
    "customers": [
        ("customer_id_missing", "customer_id IS NULL"),
        ("email_missing", "email IS NULL OR trim(email) = ''"),
    ],
    "order_items": [
        ("order_item_id_missing", "order_item_id IS NULL OR trim(order_item_id) = ''"),
        ("order_id_missing", "order_id IS NULL"),
        ("product_id_missing", "product_id IS NULL"),
        ("quantity_not_positive", "quantity IS NULL OR quantity <= 0"),
        ("unit_price_negative", "unit_price IS NULL OR unit_price < 0"),
    ],
}
sql(
    "rule_failures",
    "\nUNION ALL\n".join(
        f"""SELECT '{ds}' AS dataset, '{rule}' AS rule, COUNT(*) FILTER (WHERE COALESCE({cond}, TRUE)) AS failures,
       COALESCE(CAST(COUNT(*) FILTER (WHERE COALESCE({cond}, TRUE)) AS DOUBLE) / NULLIF(COUNT(*), 0), 0.0) AS rate
FROM raw_{ds}"""
        for ds, rules in _RULES.items()
        for rule, cond in rules
    ),
)
_COUNTS = (
    [("raw", n, f"raw_{n}") for n in ("customers", "products", "orders", "order_items", "payments", "shipments")]
    + [("silver", n, f"silver_{n}") for n in ("customers", "products", "orders", "order_items", "payments", "shipments")]
    + [("rejected", n, f"rejected_{n}") for n in ("customers", "order_items")]
    + [
        ("gold", n, n)
        for n in ("order_revenue", "product_revenue", "category_revenue", "customer_revenue", "business_kpis")
    ]
)
sql(
    "layer_run_counts",
    "\nUNION ALL\n".join(
        f"""SELECT '{layer}' AS layer, '{name}' AS dataset, COUNT(*) AS "rows" FROM {cte}""" for layer, name, cte in _COUNTS
    ),
)


_NAMES = ("customers", "products", "orders", "order_items", "payments", "shipments")
_LOG = [("raw", n, f"raw_{n}", f"raw_{n}") for n in _NAMES]
_LOG += [("validated", n, f"raw_{n}", f"silver_{n}") for n in _NAMES]
_LOG += [
    ("validated", f"{n}:rejected", f"raw_{n}", f"rejected_{n}" if n in _RULES else f"(SELECT 1 FROM raw_{n} WHERE FALSE)")
    for n in _NAMES
]
_LOG += [
    ("gold", "order_revenue", "silver_order_items", "order_revenue"),
    ("gold", "product_revenue", "silver_order_items", "product_revenue"),
    ("gold", "category_revenue", "product_revenue", "category_revenue"),
    ("gold", "customer_revenue", "order_revenue", "customer_revenue"),
    ("gold", "business_kpis", "order_revenue", "business_kpis"),
]
sql(
    "run_log",
    "\nUNION ALL\n".join(
        f"""SELECT '{layer}' AS layer, '{name}' AS dataset, {BATCH} AS batch_id,
       (SELECT COUNT(*) FROM {source}) AS rows_in, (SELECT COUNT(*) FROM {target} AS t) AS "rows\""""
        for layer, name, source, target in _LOG
    ),
)

# streaming
sql(
    "stream_ingest_events",
    f"""SELECT *, {BATCH} AS _batch_id FROM events
WHERE NOT COALESCE(event_id IS NULL OR ts IS NULL OR user_id IS NULL OR event_type IS NULL OR trim(event_type) = '', TRUE)""",
)
sql("stream_dedup_events", "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1")
sql(
    "stream_daily_counts",
    "SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2",
)

# four deliveries; a day that ended an hour before the newest event of earlier ones is closed
_DELIVERED = """WITH delivered AS (
  SELECT *, date_trunc('day', ts) + INTERVAL 1 DAY AS day_end,
         CAST(least(3, CASE WHEN ts >= TIMESTAMP '2024-01-22' THEN 3 WHEN ts >= TIMESTAMP '2024-01-15' THEN 2
                            WHEN ts >= TIMESTAMP '2024-01-08' THEN 1 ELSE 0 END
                     + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS epoch
  FROM events
), marks AS (
  SELECT epoch, max(newest) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS mark,
         max(newest) OVER (ORDER BY epoch) - INTERVAL 1 HOUR AS next_mark
  FROM (SELECT epoch, max(ts) AS newest FROM delivered GROUP BY epoch)
), judged AS (
  SELECT d.*, coalesce(d.day_end <= m.mark, FALSE) AS is_late FROM delivered d JOIN marks m USING (epoch)
)
"""
SQL["stream_late_rows"] = _DELIVERED + "SELECT epoch, event_id, ts, user_id, event_type, value FROM judged WHERE is_late"
SQL["stream_run_log"] = (
    _DELIVERED
    + """SELECT epoch, count(*) AS rows_in, count(*) FILTER (NOT is_late AND ts IS NOT NULL) AS counted,
       count(*) FILTER (is_late) AS late, count(*) FILTER (ts IS NULL) AS undated,
       (SELECT count(DISTINCT j.day_end) FROM judged j, marks m
        WHERE m.epoch = judged.epoch AND NOT j.is_late AND j.epoch <= m.epoch AND j.day_end <= m.next_mark
          AND (m.mark IS NULL OR j.day_end > m.mark)) AS days_closed
FROM judged GROUP BY epoch"""
)

# the newest event closes the days that ended an hour before it
SQL["stream_closed_days"] = """SELECT day, event_type, n
FROM (SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2)
WHERE day + INTERVAL 1 DAY <= (SELECT MAX(ts) - INTERVAL 1 HOUR FROM events)"""
sql(
    "rejected_order_items_rules",
    """SELECT order_item_id, _dq_reason,
       concat_ws(',',
         CASE WHEN order_item_id IS NULL OR trim(order_item_id) = '' THEN 'order_item_id_missing' END,
         CASE WHEN order_id IS NULL THEN 'order_id_missing' END,
         CASE WHEN product_id IS NULL THEN 'product_id_missing' END,
         CASE WHEN quantity IS NULL OR quantity <= 0 THEN 'quantity_not_positive' END,
         CASE WHEN unit_price IS NULL OR unit_price < 0 THEN 'unit_price_negative' END) AS failed_rules
FROM rejected_order_items""",
)
