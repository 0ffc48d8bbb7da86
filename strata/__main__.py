"""Command line for the on-disk run (use with ``spark-submit`` or plain ``python``).

    python -m strata all --root ROOT (--sf-dir DIR | --csv-dir DIR) [--batch-id ID] [--min-quality-rate R]
    python -m strata raw --root ROOT (--sf-dir DIR | --csv-dir DIR) [--batch-id ID]
    python -m strata validated --root ROOT [--batch-id ID]
    python -m strata marts --root ROOT

Each step takes ``--format`` (default parquet), the storage format of its tables. Every step prints one JSON object with the rows it wrote. The session comes
from the environment (``spark-submit`` settings); nothing is overridden.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from strata.functions.ids import DEFAULT_BATCH_ID
from strata.plans import layers
from strata.sources.csv_files import ingest_all_datasets


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m strata")
    parser.add_argument("step", choices=["all", "raw", "validated", "marts"])
    parser.add_argument("--root", required=True, help="folder of the run's tables (shared storage)")
    parser.add_argument("--sf-dir", help="folder of the driver tables")
    parser.add_argument("--csv-dir", help="folder of <dataset>.csv sources")
    parser.add_argument("--batch-id", default=DEFAULT_BATCH_ID)
    parser.add_argument("--min-quality-rate", type=float)
    parser.add_argument("--format", default="parquet", help="storage format of the tables")
    args = parser.parse_args(argv)
    if args.step in ("all", "raw") and not (args.sf_dir or args.csv_dir):
        parser.error("--sf-dir or --csv-dir is required for this step")

    spark = SparkSession.builder.appName(f"strata-{args.step}").getOrCreate()
    paths = layers.LayerPaths(args.root)
    if args.step == "all":
        paths = layers.run_all(
            spark, args.sf_dir, args.root, args.batch_id,
            min_quality_rate=args.min_quality_rate, source_csv_dir=args.csv_dir, fmt=args.format,
        )
        out = {f"{r.layer}/{r.dataset}": r.rows for r in layers.written_counts(spark, paths, args.format).collect()}
    elif args.step == "raw":
        if args.csv_dir:
            out = ingest_all_datasets(spark, args.csv_dir, f"{args.root}/raw", args.batch_id, args.format)
        else:
            out = layers.run_raw(spark, args.sf_dir, paths, args.batch_id, args.format)
    elif args.step == "validated":
        metrics = layers.run_silver(spark, paths, args.batch_id, args.format)
        out = {r.dataset: r.asDict() for r in metrics.drop("processed_at").collect()}  # six rows
    else:
        out = layers.run_gold(spark, paths, args.format)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
