"""The on-disk run: raw -> validated (+ rejected, quality metrics) -> marts.

Each layer reads the previous layer's files, so every written table cuts
the lineage and a lost executor only recomputes from the last table. Row
counts come from ``Observation`` during the writes (no extra scans).

* raw: the adapter tables, stamped with lineage, one table per dataset;
* validated: valid rows deduplicated where they are stored (``dedup_placed``: one
  shuffle of whole rows, no sort before it; rows of hot keys are cut down in
  their tasks), and beside them the rejected rows with their reasons, written as
  they are scanned, without a shuffle;
* marts: the order mart and the product mart are written first and read
  back, so the customer mart, the KPIs and the category mart reuse them
  instead of recomputing them.

With ``buckets`` > 0 the validated customers, orders and order lines are
written as catalog tables bucketed on the key the marts join or group on
(``BUCKET_KEYS``); the per-order totals, the orders-to-totals join and the
order check of the product mart then read them without shuffling the two
largest tables again. Rows of a hot key are written by the tasks that
deduplicated them, so no task writes a whole hot bucket. The catalog schema
lives in the run's folder. The storage format is a parameter of every step.
"""

from __future__ import annotations

import hashlib
import threading
from contextlib import contextmanager
from datetime import datetime, timezone
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.ids import DEFAULT_BATCH_ID
from strata.operators import quality
from strata.operators.dedup import dedup_placed, spread_keys
from strata.operators.joins import hot_keys
from strata.plans import gold
from strata.schemas import DATASETS, QUALITY_METRICS
from strata.sources.adapter import raw_table
from strata.sources.catalog import create_schema
from strata.sources.csv_files import ingest_all_datasets
from strata.sources.sinks import write_bucketed_observed, write_observed, write_table

T = TypeVar("T")

MARTS = ("order_revenue", "product_revenue", "category_revenue", "customer_revenue", "business_kpis")

# validated tables the marts join or group on, and that key
BUCKET_KEYS = {"customers": "customer_id", "orders": "order_id", "order_items": "order_id"}


@dataclass(frozen=True)
class LayerPaths:
    root: str
    buckets: int = 0

    @property
    def database(self) -> str:
        return "strata_run_" + hashlib.sha1(self.root.encode()).hexdigest()[:12]

    def validated_table(self, name: str) -> str:
        return f"{self.database}.validated_{name}"

    def read_silver(self, spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
        """Valid, deduplicated rows (bucketed on ``BUCKET_KEYS[name]`` when written so)."""
        if self.buckets and name in BUCKET_KEYS:
            return spark.table(self.validated_table(name))
        return spark.read.format(fmt).load(self.validated(name))

    def read_rejected(self, spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
        return spark.read.format(fmt).load(self.rejected(name))

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def validated(self, name: str) -> str:
        return f"{self.root}/validated/{name}"

    def rejected(self, name: str) -> str:
        return f"{self.root}/rejected/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    @property
    def quality(self) -> str:
        return f"{self.root}/quality"

    @property
    def run_log(self) -> str:
        """Rows written per layer and dataset, with step times (UTC)."""
        return f"{self.root}/run_log"


def concurrently(jobs: dict[str, Callable[[], T]], max_parallel: int = 6) -> dict[str, T]:
    """Run independent Spark jobs from driver threads; results keep the key order.

    The scheduler interleaves their tasks, so small tables finish next to
    large ones instead of after them. The first failure is raised.
    """
    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(jobs)))) as pool:
        futures = {k: pool.submit(fn) for k, fn in jobs.items()}
        return {k: f.result() for k, f in futures.items()}


def run_raw(
    spark: SparkSession, sf_dir: str, paths: LayerPaths, batch_id: str = DEFAULT_BATCH_ID, fmt: str = "parquet"
) -> dict[str, int]:
    """Raw layer from the driver tables (independent writes, run concurrently)."""

    def write(n: str) -> int:
        return write_observed(raw_table(spark, sf_dir, n, batch_id), paths.raw(n), f"raw_{n}", fmt)["rows"]

    return concurrently({n: (lambda n=n: write(n)) for n in DATASETS})


def run_silver(
    spark: SparkSession,
    paths: LayerPaths,
    batch_id: str = DEFAULT_BATCH_ID,
    fmt: str = "parquet",
    raw_counts: dict[str, int] | None = None,
) -> DataFrame:
    """Validated + rejected tables of all six datasets; returns the metrics table (also written).

    Counts are observed directly under each write (its result stage), where
    Spark applies each task's metrics exactly once even if executors are
    lost and tasks re-run. The input count is the raw layer's own write
    count, or else a column-free count of the raw files. The six datasets
    are processed concurrently.
    """
    if paths.buckets:
        create_schema(spark, paths.database, f"{paths.root}/catalog")
    counted = concurrently({n: (lambda n=n: _validate_one(spark, paths, n, fmt, raw_counts)) for n in DATASETS})
    rows = [
        (
            name,
            input_rows,
            valid_rows,
            rejected_rows,
            input_rows - valid_rows - rejected_rows,
            valid_rows / input_rows if input_rows else 0.0,
            batch_id,
        )
        for name, (input_rows, valid_rows, rejected_rows) in counted.items()
    ]
    # six rows, one per dataset: a bounded local table
    metrics = spark.createDataFrame(rows, QUALITY_METRICS).withColumn("processed_at", F.current_timestamp())
    write_table(metrics, paths.quality, fmt)
    return spark.read.format(fmt).load(paths.quality)


def _validate_one(
    spark: SparkSession, paths: LayerPaths, name: str, fmt: str, raw_counts: dict[str, int] | None
) -> tuple[int, int, int]:
    """(input, valid, rejected) rows of one dataset, after writing its validated and rejected tables.

    Rejected rows go straight from the scan to their table; valid rows are
    deduplicated and, for ``BUCKET_KEYS``, bucketed on the marts' key, with one
    shuffle for both.
    """
    raw = spark.read.format(fmt).load(paths.raw(name))
    valid, rejected = quality.split_by_quality(raw, name, with_failed_rules=True)
    rejected_rows = write_observed(rejected, paths.rejected(name), f"rejected_{name}", fmt)["rows"]
    bucketed = paths.buckets and name in BUCKET_KEYS
    by = BUCKET_KEYS[name] if bucketed else DATASETS[name].key
    valid = dedup_stored(valid, raw, name, by, f"{paths.root}/hot", paths.buckets if bucketed else None)
    if bucketed:
        valid_rows = write_bucketed_observed(
            valid, paths.validated(name), paths.validated_table(name), by, paths.buckets, f"validated_{name}", fmt
        )["rows"]
    else:
        valid_rows = write_observed(valid, paths.validated(name), f"validated_{name}", fmt)["rows"]
    return _input_rows(spark, raw, name, raw_counts), valid_rows, rejected_rows


def dedup_stored(
    valid: DataFrame, raw: DataFrame, name: str, by: str, root: str, partitions: int | None = None
) -> DataFrame:
    """``dedup_placed`` of the ``valid`` rows of ``raw``; the keys that it treats apart are stored below ``root``."""
    key = DATASETS[name].key
    hot = _any_rows(hot_keys(raw.select(by), [by]), f"{root}/raw_{name}")
    spread = _any_rows(spread_keys(valid, key, by), f"{root}/spread_{name}") if by != key else None
    return dedup_placed(valid, name, by, partitions, hot, spread)


def _any_rows(df: DataFrame, path: str) -> DataFrame | None:
    """``df`` written and read back, so that its size is known to whoever joins it; None if it is empty."""
    write_table(df, path)
    written = df.sparkSession.read.parquet(path)
    return None if written.isEmpty() else written


def _input_rows(spark: SparkSession, raw: DataFrame, name: str, raw_counts: dict[str, int] | None) -> int:
    if raw_counts and name in raw_counts:
        return raw_counts[name]
    return raw.count()  # Parquet: row-group counts, no column is decoded


def run_gold(spark: SparkSession, paths: LayerPaths, fmt: str = "parquet") -> dict[str, int]:
    """The five marts from the validated tables; returns name -> rows in mart order.

    The order and product marts are written first (concurrently) and read
    back; the three marts built on them are then written concurrently.
    """
    read = lambda p: spark.read.format(fmt).load(p)
    s = {n: paths.read_silver(spark, n, fmt) for n in ("customers", "products", "orders", "order_items")}
    hot = {
        "customer_id": _written_once(
            f"{paths.root}/hot/customer_id", lambda: hot_keys(s["orders"].select("customer_id"), ["customer_id"])
        ),
        "order_id": _written_once(
            f"{paths.root}/hot/order_id", lambda: hot_keys(s["order_items"].select("order_id"), ["order_id"])
        ),
    }

    def write(name: str, df: DataFrame) -> int:
        return write_observed(df, paths.gold(name), f"gold_{name}", fmt)["rows"]

    counts = concurrently(
        {
            "order_revenue": lambda: write(
                "order_revenue", gold.order_revenue(s["orders"], s["order_items"], s["customers"], hot)
            ),
            "product_revenue": lambda: write(
                "product_revenue",
                gold.product_revenue(s["orders"], s["order_items"], s["products"], s["customers"], hot),
            ),
        }
    )
    orders_mart, products_mart = read(paths.gold("order_revenue")), read(paths.gold("product_revenue"))
    counts |= concurrently(
        {
            "category_revenue": lambda: write("category_revenue", gold.category_revenue(products_mart)),
            "customer_revenue": lambda: write("customer_revenue", gold.customer_revenue(s["customers"], orders_mart)),
            "business_kpis": lambda: write("business_kpis", gold.business_kpis(orders_mart)),
        }
    )
    return {m: counts[m] for m in MARTS}


def _written_once(path: str, build: Callable[[], DataFrame]) -> Callable[[], DataFrame | None]:
    """A hot-key table built on first use, written to ``path`` (it is small:
    at most one row per shuffle partition) and read back by every later
    use, so concurrent marts share one detection pass. None if no key is hot."""
    lock = threading.Lock()
    done: list[DataFrame | None] = []

    def get() -> DataFrame | None:
        with lock:
            if not done:
                done.append(_any_rows(build(), path))
        return done[0]

    return get


ROW_BYTES = 250  # of an order line in the memory of the task that sorts its bucket, about
BUCKET_BYTES = 128 << 20


def bucket_count(spark: SparkSession, rows: int) -> int:
    """About one bucket per ``BUCKET_BYTES`` of the largest bucketed table's rows, at least
    the default parallelism."""
    return max(1, spark.sparkContext.defaultParallelism, -(-rows * ROW_BYTES // BUCKET_BYTES))


class QualityGateError(RuntimeError):
    """The validated layer of a batch is below the required quality rate."""


def check_gate(metrics: DataFrame, min_quality_rate: float) -> None:
    """Raise :class:`QualityGateError` naming every dataset below the bar.

    ``metrics`` is the six-row metrics table; only the failing rows come back
    to the driver.
    """
    failing = quality.quality_gate(metrics, min_quality_rate).where(~F.col("passed"))
    bad = [(r.dataset, r.quality_rate) for r in failing.select("dataset", "quality_rate").collect()]
    if bad:
        detail = ", ".join(f"{d}={q:.4f}" for d, q in bad)
        raise QualityGateError(f"quality gate {min_quality_rate} failed: {detail}")


def run_all(
    spark: SparkSession,
    sf_dir: str | None,
    root: str,
    batch_id: str = DEFAULT_BATCH_ID,
    buckets: int | None = None,
    min_quality_rate: float | None = None,
    source_csv_dir: str | None = None,
    fmt: str = "parquet",
) -> LayerPaths:
    """All three layers, from the driver tables in ``sf_dir`` or, with
    ``source_csv_dir``, from ``<dataset>.csv`` sources ingested as the raw
    layer. ``buckets`` defaults to :func:`bucket_count` of the raw order
    lines; 0 writes the validated tables as plain files, and formats other
    than Spark's own file formats need that. With ``min_quality_rate`` the run
    stops after the validated layer (no marts) when any dataset's quality rate
    is below it."""
    if sf_dir is None and source_csv_dir is None:
        raise ValueError("give the driver tables (sf_dir) or a CSV source folder (source_csv_dir)")
    raw_paths = LayerPaths(root)
    log = RunLog(batch_id)
    try:
        with log.step("raw") as step:
            if source_csv_dir is not None:
                raw_counts = ingest_all_datasets(spark, source_csv_dir, f"{root}/raw", batch_id, fmt)
            else:
                raw_counts = run_raw(spark, sf_dir, raw_paths, batch_id, fmt)
            step |= {n: (rows, rows) for n, rows in raw_counts.items()}
        if buckets is None:
            buckets = bucket_count(spark, raw_counts["order_items"])
        paths = LayerPaths(root, buckets)
        with log.step("validated") as step:
            metrics = run_silver(spark, paths, batch_id, fmt, raw_counts=raw_counts)
            valid = {}
            for r in metrics.select("dataset", "valid_records", "rejected_records").collect():  # six rows
                valid[r.dataset] = r.valid_records
                step[r.dataset] = (raw_counts[r.dataset], r.valid_records)
                step[f"{r.dataset}:rejected"] = (raw_counts[r.dataset], r.rejected_records)
        if min_quality_rate is not None:
            check_gate(metrics, min_quality_rate)
        with log.step("gold") as step:
            counts = run_gold(spark, paths, fmt)
            read = {
                "order_revenue": valid["order_items"],
                "product_revenue": valid["order_items"],
                "category_revenue": counts["product_revenue"],
                "customer_revenue": counts["order_revenue"],
                "business_kpis": counts["order_revenue"],
            }
            step |= {m: (read[m], counts[m]) for m in MARTS}
    finally:
        log.write(spark, raw_paths.run_log, fmt)
    return paths


class RunLog:
    """Operational metadata of one run: per layer and dataset the rows read from
    the layer before (of a mart: its largest input) and the rows written, both
    from the writes' Observations, and the step's start and end time. A bounded
    local table (one row per written table)."""

    def __init__(self, batch_id: str):
        self.batch_id = batch_id
        self.rows: list[tuple] = []

    @contextmanager
    def step(self, layer: str):
        counts: dict[str, tuple[int, int]] = {}
        started = datetime.now(timezone.utc).replace(tzinfo=None)
        try:
            yield counts
        finally:
            finished = datetime.now(timezone.utc).replace(tzinfo=None)
            for dataset, (read, written) in counts.items():
                self.rows.append((layer, dataset, self.batch_id, int(read), int(written), started, finished))

    def write(self, spark: SparkSession, path: str, fmt: str = "parquet") -> None:
        schema = (
            "layer string, dataset string, batch_id string, rows_in bigint, rows bigint, "
            "started_at timestamp_ntz, finished_at timestamp_ntz"
        )
        write_table(spark.createDataFrame(self.rows, schema), path, fmt)


def written_counts(spark: SparkSession, paths: LayerPaths, fmt: str = "parquet") -> DataFrame:
    """(layer, dataset, rows) counted by Spark from the written tables."""
    read = lambda p: spark.read.format(fmt).load(p)
    tables = [("raw", n, read(paths.raw(n))) for n in DATASETS]
    tables += [("silver", n, paths.read_silver(spark, n, fmt)) for n in DATASETS]
    tables += [("rejected", n, paths.read_rejected(spark, n, fmt)) for n in DATASETS if quality.rules_for(n)]
    tables += [("gold", n, read(paths.gold(n))) for n in MARTS]
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(layer).alias("layer"), F.lit(n).alias("dataset"), "rows")
        for layer, n, df in tables
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
