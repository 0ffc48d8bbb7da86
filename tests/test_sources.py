import os

import pytest

from strata.schemas import ORDER_ITEMS
from strata.sources import catalog, csv_files
from strata.sources.sinks import append_partition, write_observed


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


HEADER = "order_item_id,order_id,product_id,quantity,unit_price,line_amount\n"


def test_permissive_read_keeps_rows(spark, scratch):
    p = f"{scratch}/order_items.csv"
    write(
        p,
        HEADER
        + "a,1,1,x,1.0,1.0\n"  # bad int -> NULL, row kept
        + "b,1,1,99999999999,1.0,1.0\n"  # overflowing int -> NULL
        + "c,1\n"  # short row
        + 'd,1,1,2,1.0,1.0,extra\n'  # long row
        + '"",1,1,2,1.0,1.0\n',  # quoted empty -> NULL
    )
    df = csv_files.read_source_csv(spark, p, ORDER_ITEMS, "b1")
    rows = {r.order_item_id: r for r in df.collect()}
    assert df.count() == 5
    assert rows["a"].quantity is None and rows["b"].quantity is None and rows["c"].product_id is None
    assert rows["d"].quantity == 2 and None in rows
    assert {r._batch_id for r in df.collect()} == {"b1"} and all(r._source_file for r in df.collect())


def test_strict_read_quarantines_and_checks_header(spark, scratch):
    p = f"{scratch}/strict/order_items.csv"
    full = HEADER.strip() + ",supplier_id,ship_date\n"
    write(p, full + "a,1,1,x,1.0,1.0,7,2024-01-01T00:00:00\nb,1,1,2,1.0,1.0,7,2024-01-01T00:00:00\n")
    good, _ = csv_files.read_strict_csv(spark, p, ORDER_ITEMS)
    assert [r.order_item_id for r in good.collect()] == ["b"]
    counts = csv_files.strict_ingest(spark, p, ORDER_ITEMS, f"{scratch}/strict_out")
    assert counts == {"loaded": 1, "quarantined": 1}
    bad = spark.read.parquet(f"{scratch}/strict_out/load_status=quarantined").collect()
    assert len(bad) == 1 and bad[0]._corrupt_record.startswith("a,1,1,x")
    q = f"{scratch}/wrong/order_items.csv"
    write(q, "order_id,order_item_id,product_id,quantity,unit_price,line_amount,supplier_id,ship_date\n1,a,1,1,1.0,1.0,7,\n")
    with pytest.raises(Exception):
        csv_files.read_strict_csv(spark, q, ORDER_ITEMS)[0].collect()


def test_ingest_errors_and_count(spark, scratch):
    with pytest.raises(ValueError):
        csv_files.ingest_dataset(spark, "nope", scratch, scratch, "b")
    with pytest.raises(FileNotFoundError):
        csv_files.ingest_dataset(spark, "order_items", f"{scratch}/missing", scratch, "b")
    write(f"{scratch}/src/order_items.csv", HEADER + "a,1,1,1,1.0,1.0\nb,1,1,1,1.0,1.0\n")
    assert csv_files.ingest_dataset(spark, "order_items", f"{scratch}/src", f"{scratch}/raw", "b") == 2
    assert spark.read.parquet(f"{scratch}/raw/order_items").count() == 2


def test_write_csv_refuses_empty(spark, scratch):
    with pytest.raises(ValueError):
        csv_files.write_csv(spark.range(0), f"{scratch}/empty")


def test_observed_write_and_history(spark, scratch):
    df = spark.range(10)
    assert write_observed(df, f"{scratch}/t", "t")["rows"] == 10
    h = f"{scratch}/hist"
    for batch, n in (("b1", 3), ("b2", 4), ("b2", 5)):
        append_partition(spark.range(n).selectExpr(f"'{batch}' AS batch_id", "id"), h, "batch_id")
    got = {r.batch_id: r["count"] for r in spark.read.parquet(h).groupBy("batch_id").count().collect()}
    assert got == {"b1": 3, "b2": 5}


def test_session_info(spark):
    r = catalog.session_info(spark).first()
    assert r.catalog == "spark_catalog" and r.schemas >= 1


def source_rows(spark, sf, name):
    from strata.sources.adapter import source_rows as rows

    return rows(spark, sf, name)


def test_text_ids_survive_ingestion(spark, scratch):
    write(
        f"{scratch}/src/customers.csv",
        "customer_id,full_name,email,state,created_at\nCUST-000001,A,a@x,S,\nCUST-000002,B,b@x,S,\n   ,C,c@x,S,\n",
    )
    assert csv_files.ingest_dataset(spark, "customers", f"{scratch}/src", f"{scratch}/raw", "b") == 3
    from strata.plans.silver import validate

    valid, rejected = validate(spark.read.parquet(f"{scratch}/raw/customers"), "customers")
    assert sorted(r.customer_id for r in valid.collect()) == ["CUST-000001", "CUST-000002"]
    assert [r.full_name for r in rejected.collect()] == ["C"]


def test_ingest_all_in_schema_order(spark, scratch):
    from strata.schemas import DATASETS

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    for name in DATASETS:
        csv_files.write_csv(source_rows(spark, sf, name), f"{scratch}/src/{name}.csv")
    counts = csv_files.ingest_all_datasets(spark, f"{scratch}/src", f"{scratch}/raw", "b1")
    assert list(counts) == list(DATASETS)
    for name, n in counts.items():
        assert n == source_rows(spark, sf, name).count()
    back = spark.read.parquet(f"{scratch}/raw/orders").select("order_id", "order_timestamp")
    src = source_rows(spark, sf, "orders").select("order_id", "order_timestamp")
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_bucketed_layer_avoids_item_shuffles(spark, scratch):
    from strata.plans import gold, layers

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    paths = layers.LayerPaths(f"{scratch}/run", buckets=4)
    counts = layers.run_raw(spark, sf, paths)
    layers.run_silver(spark, paths, raw_counts=counts)
    s = {n: paths.read_silver(spark, n) for n in ("customers", "orders", "order_items")}
    df = gold.order_revenue(s["orders"], s["order_items"], s["customers"])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_id" not in plan
    plain = layers.LayerPaths(f"{scratch}/plain")
    layers.run_raw(spark, sf, plain)
    layers.run_silver(spark, plain)
    p = {n: plain.read_silver(spark, n) for n in ("customers", "orders", "order_items")}
    expected = gold.order_revenue(p["orders"], p["order_items"], p["customers"])
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, expected.collect()))


def test_local_rows_range_and_catalog_listing(spark, scratch):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    from strata.sources import local_rows

    assert local_rows.stamped_range(spark, 1, 6).count() == 5
    schema = StructType(
        [
            StructField("customer_id", IntegerType(), False),
            StructField("full_name", StringType(), False),
            StructField("email", StringType(), True),
        ]
    )
    catalog.create_schema(spark, "strata_local_test", f"{scratch}/db")
    rows = [(1, "A", "a@x"), (2, "B", None)]
    got = local_rows.load_rows_to_table(spark, rows, schema, "strata_local_test.customers")
    assert sorted(r.customer_id for r in got.collect()) == [1, 2] and "_ingestion_timestamp" in got.columns
    with pytest.raises(Exception):
        local_rows.rows_with_schema(spark, [(None, "x", None)], schema).collect()
    assert "spark_catalog" in [r[0] for r in catalog.list_catalogs(spark).collect()]
    assert "strata_local_test" in [r[0] for r in catalog.list_schemas(spark).collect()]
    assert catalog.current_location(spark).first().current_catalog == "spark_catalog"


def test_overwrite_replaces_table_schema(spark, scratch):
    catalog.create_schema(spark, "strata_schema_test", f"{scratch}/db2")
    catalog.save_as_table(spark.range(3).selectExpr("id", "'x' AS a"), "strata_schema_test.t")
    catalog.save_as_table(spark.range(2).selectExpr("id", "1.5 AS b", "true AS c"), "strata_schema_test.t")
    t = catalog.read_table(spark, "strata_schema_test.t")
    assert t.columns == ["id", "b", "c"] and t.count() == 2


def test_csv_timestamps_with_offsets(spark, scratch):
    from strata.schemas import ORDERS

    p = f"{scratch}/orders.csv"
    write(
        p,
        "order_id,customer_id,order_timestamp,order_status\n"
        "1,1,2024-01-01T02:00:00+02:00,completed\n"
        "2,1,2024-01-01T00:00:00,completed\n"
        "3,1,2024-01-01T00:00:00+00:00,completed\n"
        "4,1,not a time,completed\n",
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = {r.order_id: r.order_timestamp for r in csv_files.read_source_csv(spark, p, ORDERS, "b").collect()}
        good, _ = csv_files.read_strict_csv(spark, p, ORDERS)
        strict_ids = sorted(r.order_id for r in good.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    import datetime as dt

    midnight = dt.datetime(2024, 1, 1)
    assert got == {1: midnight, 2: midnight, 3: midnight, 4: None}
    assert strict_ids == [1, 2, 3]


def test_validated_layer_metrics_with_duplicates(spark, scratch):
    from strata.plans import layers
    from strata.schemas import DATASETS

    paths = layers.LayerPaths(f"{scratch}/run")
    rows = {
        "customers": [(1, "A", "a@x", "S", None), (1, "B", "b@x", "S", None), (2, "C", "", "S", None)],
        "order_items": [("x", 1, 1, 1, 1.0, None, None, None), ("x", 1, 2, 1, 1.0, None, None, None), ("y", 1, 1, 0, 1.0, None, None, None)],
    }
    from pyspark.sql import functions as F

    from strata.schemas import nullable

    for name, ds in DATASETS.items():
        df = spark.createDataFrame(rows.get(name, []), nullable(ds.schema)).withColumns(
            {"_ingestion_timestamp": F.current_timestamp(), "_source_file": F.lit("f"), "_batch_id": F.lit("b")}
        )
        df.write.mode("overwrite").parquet(paths.raw(name))
    m = {r.dataset: r for r in layers.run_silver(spark, paths, "b").collect()}
    c, i = m["customers"], m["order_items"]
    assert (c.input_records, c.valid_records, c.rejected_records, c.duplicate_records) == (3, 1, 1, 1)
    assert (i.input_records, i.valid_records, i.rejected_records, i.duplicate_records) == (3, 1, 1, 1)
    assert m["products"].quality_rate == 0.0  # empty input
    kept = paths.read_silver(spark, "order_items").first()
    assert kept.product_id == 1  # fixed survivor: the smaller product id
    rejected = paths.read_rejected(spark, "order_items").first()
    assert list(rejected._dq_failed_rules) == ["quantity_not_positive"]
    # empty datasets read back as empty tables with their schema
    assert paths.read_silver(spark, "products").count() == 0
    assert "product_id" in paths.read_rejected(spark, "products").columns
    assert paths.read_silver(spark, "shipments").count() == 0
    assert paths.read_rejected(spark, "customers").count() == 1


def test_layer_run_quality_gate(spark, scratch):
    from strata.plans import layers

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    with pytest.raises(layers.QualityGateError, match="order_items"):
        layers.run_all(spark, sf, f"{scratch}/gated", min_quality_rate=0.95)
    assert not os.path.exists(f"{scratch}/gated/gold")  # no marts after a failed gate
    paths = layers.run_all(spark, sf, f"{scratch}/passed", min_quality_rate=0.5)
    assert spark.read.parquet(paths.gold("business_kpis")).count() == 1


def test_layer_run_from_csv_sources(spark, scratch):
    from strata.plans import layers
    from strata.schemas import DATASETS

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    for name in DATASETS:
        csv_files.write_csv(source_rows(spark, sf, name), f"{scratch}/src/{name}.csv")
    from_csv = layers.run_all(spark, None, f"{scratch}/csv_run", source_csv_dir=f"{scratch}/src")
    from_tables = layers.run_all(spark, sf, f"{scratch}/table_run")
    got = {(r.layer, r.dataset): r.rows for r in layers.written_counts(spark, from_csv).collect()}
    want = {(r.layer, r.dataset): r.rows for r in layers.written_counts(spark, from_tables).collect()}
    # blank e-mails become NULL through CSV; both are rejected, so every count agrees
    assert got == want
    ids = spark.read.parquet(from_csv.gold("order_revenue")).select("order_id", "customer_id").first()
    assert ids.order_id.startswith("ORD-") and ids.customer_id.startswith("CUST-")
    kpi_csv = spark.read.parquet(from_csv.gold("business_kpis")).first()
    kpi_tab = spark.read.parquet(from_tables.gold("business_kpis")).first()
    assert (kpi_csv.total_orders, kpi_csv.active_customers) == (kpi_tab.total_orders, kpi_tab.active_customers)


def test_bucketed_write_spreads_hot_keys_and_keeps_rejects_apart(spark, scratch):
    from pyspark.sql import functions as F

    from strata.plans import layers
    from strata.schemas import DATASETS, nullable

    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"  # the few rows here would all go to one task
    before = spark.conf.get(coalesce)
    spark.conf.set("strata.skew.sampleFraction", "1.0")
    spark.conf.set(coalesce, "false")
    try:
        paths = layers.LayerPaths(f"{scratch}/run", buckets=8)
        for name, ds in DATASETS.items():
            rows = []
            if name == "order_items":  # order 7 has half of the valid lines; a third of all lines has no order
                rows = [(f"i{i}", None if i % 3 == 0 else (7 if i % 2 else i), 1, 1, 1.0, None, None, None) for i in range(900)]
            spark.createDataFrame(rows, nullable(ds.schema)).repartition(6).withColumns(
                {"_ingestion_timestamp": F.current_timestamp(), "_source_file": F.lit("f"), "_batch_id": F.lit("b")}
            ).write.parquet(paths.raw(name))
        layers.run_silver(spark, paths, "b")
        valid = paths.read_silver(spark, "order_items").withColumn("f", F.input_file_name())
        assert valid.count() == 600
        assert valid.where("order_id = 7").select("f").distinct().count() > 1  # not one task's file
        rejected = paths.read_rejected(spark, "order_items").withColumn("f", F.input_file_name())
        assert rejected.count() == 300 and rejected.select("f").distinct().count() > 1
    finally:
        spark.conf.unset("strata.skew.sampleFraction")
        spark.conf.set(coalesce, before)


def test_layer_run_in_another_format(spark, scratch):
    from strata.plans import layers

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    paths = layers.run_all(spark, sf, f"{scratch}/orc", fmt="orc")
    assert spark.read.orc(paths.gold("business_kpis")).first().total_orders == 944


def test_run_log_of_the_on_disk_run(spark, scratch):
    from strata.plans import layers

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    paths = layers.run_all(spark, sf, f"{scratch}/logged")
    log = {(r.layer, r.dataset): r for r in spark.read.parquet(paths.run_log).collect()}
    counts = {(r.layer, r.dataset): r.rows for r in layers.written_counts(spark, paths).collect()}
    def log_key(layer, dataset):  # the log names the validated layer's two sides
        if layer == "silver":
            return ("validated", dataset)
        if layer == "rejected":
            return ("validated", f"{dataset}:rejected")
        return (layer, dataset)

    for (layer, dataset), n in counts.items():
        assert log[log_key(layer, dataset)].rows == n, (layer, dataset)
    assert log["validated", "orders"].rows_in == counts["raw", "orders"]
    assert all(r.started_at <= r.finished_at for r in log.values())
    with pytest.raises(layers.QualityGateError):
        layers.run_all(spark, sf, f"{scratch}/gated_log", min_quality_rate=0.99)
    layers_logged = {r.layer for r in spark.read.parquet(f"{scratch}/gated_log/run_log").collect()}
    assert layers_logged == {"raw", "validated"}  # the log is written even when the gate stops the run


def test_command_line_steps(scratch):
    import json
    import subprocess
    import sys

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = f"{scratch}/cli"

    def run(*args):
        proc = subprocess.run(
            [sys.executable, "-m", "strata", *args], capture_output=True, text=True, timeout=600, cwd=repo
        )
        assert proc.returncode == 0, proc.stderr[-2000:]
        return json.loads(proc.stdout.strip().splitlines()[-1])

    raw = run("raw", "--root", root, "--sf-dir", sf)
    assert raw["order_items"] > 0
    validated = run("validated", "--root", root)
    assert validated["order_items"]["input_records"] == raw["order_items"]
    marts = run("marts", "--root", root)
    assert marts["business_kpis"] == 1
    everything = run("all", "--root", f"{scratch}/cli_all", "--sf-dir", sf, "--min-quality-rate", "0.5")
    assert everything["gold/business_kpis"] == 1
    assert everything["raw/order_items"] == raw["order_items"]


def test_a_layer_run_is_shared_until_the_input_changes(spark, scratch, monkeypatch):
    from strata import queries

    runs = []
    monkeypatch.setattr(queries.layers, "run_all", lambda *a, **k: runs.append(a) or len(runs))
    spark.range(5).write.parquet(f"{scratch}/orders.parquet")
    assert [queries._on_disk_run(spark, scratch) for _ in range(2)] == [1, 1]
    spark.range(6).write.mode("overwrite").parquet(f"{scratch}/orders.parquet")
    assert [queries._on_disk_run(spark, scratch) for _ in range(2)] == [2, 2]
