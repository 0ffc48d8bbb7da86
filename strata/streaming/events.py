"""Streaming ingestion, dedup and windowed counts of the events table.

All jobs read a *directory* as a file stream with an explicit schema and
``trigger(availableNow=True)``: everything present is processed in bounded
micro-batches, then the query stops; a second run with the same checkpoint
picks up only new files. Checkpoints and outputs live below the session's
shared scratch root.

* ``ingest``: lineage columns, then ``foreachBatch`` writes each micro-batch
  once, partitioned into valid / rejected rows, overwriting one directory
  per epoch, so a replayed epoch rewrites its own output instead of
  duplicating it.
* ``dedup``: one row per ``event_id``, whatever the order and number of the
  micro-batches and the event times of its deliveries, from keyed state. No row
  is late: input rows = kept rows + duplicates. A bounded variant frees state
  behind a watermark.
* ``daily_counts``: tumbling one-day windows per event type; either the
  complete result is rewritten each epoch (complete mode through
  ``foreachBatch``), or closed days are appended and late rows dropped.
* ``accounted_days``: the closed days again, with every late row kept in a side
  output and a log in which input = counted + late + undated for every epoch.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from strata.functions.predicates import is_missing, total
from strata.session import utc
from strata.sources.sinks import append_partition
from strata.streaming import runlog

EVENTS_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)

WATERMARK = "1 hour"  # fixed: events later than one hour behind the newest are late


def event_rules() -> list[tuple[str, Column]]:
    return [
        ("event_id_missing", is_missing("event_id", LongType())),
        ("ts_missing", is_missing("ts", TimestampNTZType())),
        ("user_id_missing", is_missing("user_id", LongType())),
        ("event_type_missing", is_missing("event_type", StringType())),
    ]


def rejected_event() -> Column:
    rules = [c for _, c in event_rules()]
    any_failed = rules[0]
    for c in rules[1:]:
        any_failed = any_failed | c
    return total(any_failed)


MAX_FILES_PER_TRIGGER = 1000  # bounded micro-batches; tests use 1 to see one file per batch


def read_event_stream(
    spark: SparkSession, source_dir: str, file_glob: str = "*.parquet", max_files: int = MAX_FILES_PER_TRIGGER
) -> DataFrame:
    """File stream of event Parquet files; ``ts`` as an event-time timestamp (read as UTC)."""
    return (
        spark.readStream.schema(EVENTS_SCHEMA)
        .option("pathGlobFilter", file_glob)
        .option("maxFilesPerTrigger", max_files)
        .parquet(source_dir)
        .withColumn("event_time", F.col("ts").cast("timestamp"))
    )


def _run(writer, log_dir: str | None = None) -> None:
    """Start the stream and wait for its end; its progress is written to ``log_dir``, if given."""
    log = runlog.ProgressLog.attached(SparkSession.active()) if log_dir else None
    try:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    finally:
        if log:
            log.write(str(q.runId), log_dir)


def ingest(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint: str,
    batch_id: str,
    file_glob: str = "*.parquet",
    max_files: int = MAX_FILES_PER_TRIGGER,
) -> None:
    with utc(spark):
        _ingest(spark, source_dir, out_dir, checkpoint, batch_id, file_glob, max_files)


def _ingest(
    spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, batch_id: str, file_glob: str, max_files: int
) -> None:
    stream = read_event_stream(spark, source_dir, file_glob, max_files).drop("event_time").withColumns(
        {
            "_ingestion_timestamp": F.current_timestamp(),
            "_source_file": F.col("_metadata.file_path"),
            "_batch_id": F.lit(batch_id),
        }
    )

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        # one pass over the micro-batch; a replayed epoch overwrites its own directory
        bad = rejected_event()
        split = batch.withColumns(
            {
                "_dq_reason": F.when(bad, F.lit("invalid_event")),
                "dq_status": F.when(bad, F.lit("rejected")).otherwise(F.lit("valid")),
            }
        )
        split.write.mode("overwrite").partitionBy("dq_status").parquet(f"{out_dir}/epoch={epoch_id}")

    _run(stream.writeStream.foreachBatch(write_epoch).option("checkpointLocation", checkpoint))


def read_ingested(spark: SparkSession, out_dir: str, status: str = "valid") -> DataFrame:
    """Rows of all epochs written by :func:`ingest` with the given status."""
    df = spark.read.parquet(out_dir).where(F.col("dq_status") == status).drop("dq_status", "epoch")
    return df.drop("_dq_reason") if status == "valid" else df


# settings of the streams with keyed state: on local disk, changes checkpointed per epoch
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _keyed_state(spark: SparkSession):
    """Streams started in the block keep their state in RocksDB (a stream copies the settings when it starts)."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dedup(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint: str,
    file_glob: str = "*.parquet",
    max_files: int = MAX_FILES_PER_TRIGGER,
    horizon: str | None = None,
    log_dir: str | None = None,
) -> None:
    """Write each event once below ``out_dir``, one folder per epoch.

    Exact (``horizon`` None): keyed state holds, per event id, its first delivery (the
    smallest row of the first epoch that had the id) and the time of its last one; an id
    is new in an epoch when the two are of the same epoch. An epoch reads its own files
    and the state of the ids in them, never earlier rows, and many copies of an id leave
    a map task as one. State grows by one row per id.

    Bounded (``horizon`` an interval): Spark's within-watermark dedup; the state of an id
    is freed once the watermark is ``horizon`` past it, redeliveries within that time are
    dropped, and rows behind the watermark are dropped as late.

    A replayed epoch has the same files, state and epoch time, and overwrites its folder.
    """
    columns = EVENTS_SCHEMA.names
    with utc(spark), _keyed_state(spark):
        stream = read_event_stream(spark, source_dir, file_glob, max_files)
        if horizon is None:
            arrived = stream.withColumn("_arrived", F.current_timestamp())  # one time per epoch
            kept = arrived.groupBy("event_id").agg(
                F.min(F.struct("_arrived", *columns)).alias("_first"), F.max("_arrived").alias("_last")
            )
            mode = "update"
        else:
            kept = stream.withWatermark("event_time", horizon).dropDuplicatesWithinWatermark(["event_id"])
            mode = "append"

        def write_epoch(batch: DataFrame, epoch_id: int) -> None:
            if horizon is None:
                batch = batch.where("_first._arrived = _last").select("_first.*")
            batch.select(*columns).write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch_id}")

        _run(kept.writeStream.outputMode(mode).foreachBatch(write_epoch).option("checkpointLocation", checkpoint), log_dir)


def read_deduplicated(spark: SparkSession, out_dir: str) -> DataFrame:
    """All events written by :func:`dedup`."""
    schema = StructType([*EVENTS_SCHEMA.fields, StructField("epoch", LongType())])
    return spark.read.schema(schema).parquet(out_dir).drop("epoch")


def daily_counts(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint: str,
    file_glob: str = "*.parquet",
    mode: str = "complete",
    max_files: int = MAX_FILES_PER_TRIGGER,
) -> None:
    """Events per (UTC day, event type).

    ``complete``: the whole result is rewritten each epoch and equals the
    batch answer (late rows are kept, and no state is freed). ``append``: a
    day is written once the watermark passes its end, rows older than the
    previous micro-batch's watermark are dropped as late, and the state of
    closed days is freed.
    """
    if mode not in ("complete", "append"):
        raise ValueError(f"unsupported mode {mode!r}")
    with utc(spark):
        _daily_counts(spark, source_dir, out_dir, checkpoint, file_glob, mode, max_files)


def _daily_counts(
    spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, file_glob: str, mode: str, max_files: int
) -> None:
    counts = (
        read_event_stream(spark, source_dir, file_glob, max_files)
        .withWatermark("event_time", WATERMARK)
        .groupBy(F.window("event_time", "1 day").alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_date(F.col("w.start")).alias("day"), "event_type", "n")
    )
    if mode == "append":
        _run(
            counts.writeStream.outputMode("append")
            .format("parquet")
            .option("path", out_dir)
            .option("checkpointLocation", checkpoint)
        )
        return

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_dir)

    _run(counts.writeStream.outputMode("complete").foreachBatch(write_epoch).option("checkpointLocation", checkpoint))


# ---------------------------------------------------------------- counts with late rows accounted for


def accounted_days(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint: str,
    file_glob: str = "*.parquet",
    max_files: int = MAX_FILES_PER_TRIGGER,
) -> None:
    """Events per (UTC day, type) of closed days, the late rows, and a log of every epoch.

    Below ``out_dir``: ``closed`` (counts, written once a day is closed), ``late`` (whole
    rows of days that an earlier epoch has closed), ``log`` (one row per epoch) and
    ``open`` (partial counts by day and epoch), plus ``progress`` from the stream's listener.

    An epoch's watermark is the newest event time of the epochs before it less ``WATERMARK``;
    a row whose day ends at or before it is late. A day is closed by the epoch that moves the
    watermark past its end, at once; Spark's own operator (append mode of
    :func:`daily_counts`) takes rows of that day for one more epoch, but only counts what it
    drops, after partial aggregation. The epoch's rows are counted as they are split, so the
    log is exact; an epoch reads its own files, the log, and the partial counts of the days it
    closes. A replayed epoch overwrites what it wrote.
    """
    with utc(spark):
        stream = read_event_stream(spark, source_dir, file_glob, max_files)

        def write_epoch(batch: DataFrame, epoch_id: int) -> None:
            _account(batch, epoch_id, out_dir)

        _run(stream.writeStream.foreachBatch(write_epoch).option("checkpointLocation", checkpoint), f"{out_dir}/progress")


LOG_SCHEMA = (
    "epoch long, rows_in long, counted long, late long, undated long, watermark timestamp, newest timestamp, days_closed long"
)


def _account(batch: DataFrame, epoch_id: int, out_dir: str) -> None:
    spark = batch.sparkSession
    delay = F.expr(f"INTERVAL {WATERMARK}")
    before = None
    if epoch_id > 0:
        earlier = spark.read.schema(LOG_SCHEMA).parquet(f"{out_dir}/log").where(F.col("epoch") < epoch_id)
        before = earlier.agg(F.max("newest")).first()[0]
    watermark = F.lit(before).cast("timestamp") - delay

    ends = F.date_trunc("day", "event_time") + F.expr("INTERVAL 1 DAY")
    tagged = batch.withColumn("_late", F.coalesce(ends <= watermark, F.lit(False)))
    seen = Observation(f"epoch_{uuid.uuid4().hex[:8]}")
    counted = ~F.col("_late") & F.col("event_time").isNotNull()
    tagged.observe(
        seen,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(counted).alias("counted"),
        F.count_if("_late").alias("late"),
        F.count_if(F.col("event_time").isNull()).alias("undated"),
        F.max("event_time").alias("newest"),
    ).where("_late").select(*EVENTS_SCHEMA.names).write.mode("overwrite").parquet(f"{out_dir}/late/epoch={epoch_id}")
    rows = seen.get

    days = (
        tagged.where(counted)
        .groupBy(F.to_date("event_time").alias("day"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("epoch", F.lit(epoch_id).cast("long"))
    )
    append_partition(days, f"{out_dir}/open", ["day", "epoch"])

    newest = max((t for t in (before, rows["newest"]) if t is not None), default=None)
    closing = F.col("day") + F.expr("INTERVAL 1 DAY") <= F.lit(newest).cast("timestamp") - delay
    already = F.coalesce(F.col("day") + F.expr("INTERVAL 1 DAY") <= watermark, F.lit(False))
    parts = spark.read.schema("event_type string, n long, day date, epoch long").parquet(f"{out_dir}/open")
    closed = (
        parts.where(closing & ~already & (F.col("epoch") <= epoch_id))  # partition columns: only these folders are read
        .groupBy("day", "event_type")
        .agg(F.sum("n").alias("n"))
    )
    closed.write.mode("overwrite").parquet(f"{out_dir}/closed/epoch={epoch_id}")
    days_closed = spark.read.schema("day date").parquet(f"{out_dir}/closed/epoch={epoch_id}").distinct().count()
    log = spark.createDataFrame(
        [(epoch_id, rows["rows_in"], rows["counted"], rows["late"], rows["undated"], None, newest, days_closed)], LOG_SCHEMA
    )
    log.withColumn("watermark", watermark).drop("epoch").write.mode("overwrite").parquet(f"{out_dir}/log/epoch={epoch_id}")


def read_late(spark: SparkSession, out_dir: str) -> DataFrame:
    """Late rows of :func:`accounted_days`, with the epoch that brought them."""
    return spark.read.schema(StructType([*EVENTS_SCHEMA.fields, StructField("epoch", LongType())])).parquet(f"{out_dir}/late")


def read_closed_days(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema("day date, event_type string, n long, epoch long").parquet(f"{out_dir}/closed").drop("epoch")


def read_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row per epoch of :func:`accounted_days`, with the duration that the stream's listener reported.

    (The listener's own row count is of rows scanned: two passes over an epoch's files.)
    """
    progress = runlog.read_progress(spark, f"{out_dir}/progress").select("epoch", "batch_millis")
    return spark.read.schema(LOG_SCHEMA).parquet(f"{out_dir}/log").join(progress, "epoch", "left")
