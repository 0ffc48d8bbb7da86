"""Subprocess helper for tests/test_retries.py: observed counts under task retries.

Runs with a local master that allows task retries; a Python UDF fails the
first attempt of every task of the write stage, after the observation point
has already seen its rows.
"""

import os
import sys

from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

sys.path.insert(0, sys.argv[2])

from strata.sources.sinks import write_observed  # noqa: E402


def main(out: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,3]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    marks = out + "_failures"
    os.makedirs(marks, exist_ok=True)

    @F.udf(BooleanType())
    def fail_first_attempt(x):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and x % 250 == 249:
            open(os.path.join(marks, f"p{ctx.partitionId()}-{x}"), "w").close()
            raise RuntimeError("injected task failure")
        return True

    # a shuffle first, so the write's stage is the result stage after an exchange
    df = spark.range(1000).repartition(4, "id").where(fail_first_attempt(F.col("id")))
    counts = write_observed(df, out, "retry")
    written = spark.read.parquet(out).count()
    print(f"RESULT observed={counts['rows']} written={written} injected={len(os.listdir(marks))}")


if __name__ == "__main__":
    main(sys.argv[1])
