import datetime as dt
import time

from strata.streaming import events
from strata.streaming.events import EVENTS_SCHEMA


def land(spark, path, rows):
    spark.createDataFrame(rows, EVENTS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    time.sleep(0.05)  # distinct modification times: files are taken oldest first


def ev(i, minute, etype="click"):
    return (i, dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute), 1, etype, 1.0, "{}")


def test_dedup_is_exact_with_one_file_per_batch(spark, scratch):
    src = f"{scratch}/landing"
    day = 60 * 24
    land(spark, f"{src}/f=1", [ev(1, 0), ev(2, 1), ev(3, 3 * day), ev(3, 3 * day)])
    land(spark, f"{src}/f=2", [ev(2, 1), ev(4, 299)])  # a redelivery, and a row two days late
    land(spark, f"{src}/f=3", [ev(5, day), ev(1, 0), (None, None, 1, "click", 1.0, "{}")])
    land(spark, f"{src}/f=4", [ev(3, 3 * day), ev(6, -day), (None, None, 1, "click", 1.0, "{}")])
    events.dedup(spark, src, f"{scratch}/out", f"{scratch}/ckpt", max_files=1)
    out = events.read_deduplicated(spark, f"{scratch}/out")
    everything = spark.read.parquet(src).select(*EVENTS_SCHEMA.names)
    want = everything.dropDuplicates(["event_id"])
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    duplicates = everything.count() - everything.select("event_id").distinct().count()
    assert everything.count() == out.count() + duplicates  # no late row is lost


def test_dedup_drops_a_redelivery_on_another_day(spark, scratch):
    src = f"{scratch}/landing"
    day = 60 * 24
    no_time = (4, None, 1, "click", 1.0, "{}")
    land(spark, f"{src}/f=1", [ev(1, day - 1), ev(1, day), ev(2, 5), ev(4, 7)])  # across midnight within a batch
    land(spark, f"{src}/f=2", [ev(2, 3 * day), no_time, ev(5, 1)])  # corrected; null against set
    land(spark, f"{src}/f=3", [ev(2, -day), ev(5, 2 * day), ev(6, 0), (None, None, 1, "click", 1.0, "{}")])
    land(spark, f"{src}/f=4", [ev(1, 9 * day), (None, dt.datetime(2024, 1, 5), 1, "click", 1.0, "{}")])
    events.dedup(spark, src, f"{scratch}/out", f"{scratch}/ckpt", max_files=1)
    out = events.read_deduplicated(spark, f"{scratch}/out").collect()
    assert sorted(str(r.event_id) for r in out) == ["1", "2", "4", "5", "6", "None"]
    first = {r.event_id: r.ts for r in out}
    assert first[1] == ev(1, day - 1)[1]


def test_replayed_dedup_epoch_changes_nothing(spark, scratch):
    import os

    src = f"{scratch}/landing"
    land(spark, f"{src}/f=1", [ev(1, 0), ev(2, 1)])
    land(spark, f"{src}/f=2", [ev(2, 1), ev(3, 2)])
    events.dedup(spark, src, f"{scratch}/out", f"{scratch}/ckpt", max_files=1)
    for name in ("1", ".1.crc"):  # the second epoch was written but not committed
        os.remove(f"{scratch}/ckpt/commits/{name}")
    events.dedup(spark, src, f"{scratch}/out", f"{scratch}/ckpt", max_files=1)
    assert sorted(r.event_id for r in events.read_deduplicated(spark, f"{scratch}/out").collect()) == [1, 2, 3]


def test_ingest_split_and_rerun_takes_only_new_files(spark, scratch):
    src = f"{scratch}/landing"
    land(spark, f"{src}/f=1", [ev(1, 0), (2, None, 1, "click", 1.0, "{}")])
    events.ingest(spark, src, f"{scratch}/out", f"{scratch}/ckpt", "b1")
    assert events.read_ingested(spark, f"{scratch}/out", "valid").count() == 1
    rejected = events.read_ingested(spark, f"{scratch}/out", "rejected").collect()
    assert len(rejected) == 1 and rejected[0]._dq_reason == "invalid_event"
    land(spark, f"{src}/f=2", [ev(3, 5)])
    events.ingest(spark, src, f"{scratch}/out", f"{scratch}/ckpt", "b1")
    assert sorted(r.event_id for r in events.read_ingested(spark, f"{scratch}/out").collect()) == [1, 3]
    # a run without new files writes nothing and changes nothing
    events.ingest(spark, src, f"{scratch}/out", f"{scratch}/ckpt", "b1")
    assert events.read_ingested(spark, f"{scratch}/out").count() == 2


def test_daily_counts(spark, scratch):
    src = f"{scratch}/landing"
    land(spark, f"{src}/f=1", [ev(1, 0), ev(2, 60 * 24 + 1), ev(3, 2, "view")])
    events.daily_counts(spark, src, f"{scratch}/out", f"{scratch}/ckpt")
    got = sorted((str(r.day), r.event_type, r.n) for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got == [("2024-01-01", "click", 1), ("2024-01-01", "view", 1), ("2024-01-02", "click", 1)]


def test_session_time_zone_is_restored(spark, scratch):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        src = f"{scratch}/landing"
        land(spark, f"{src}/f=1", [ev(1, 0), ev(2, 60 * 23 + 30)])
        events.daily_counts(spark, src, f"{scratch}/out", f"{scratch}/ckpt")
        got = sorted((str(r.day), r.n) for r in spark.read.parquet(f"{scratch}/out").collect())
        assert got == [("2024-01-01", 2)]  # days are UTC days of the event time
        assert spark.conf.get("spark.sql.session.timeZone") == "America/Sao_Paulo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_daily_counts_append_drops_late_rows(spark, scratch):
    # Late rows are judged against the previous micro-batch's watermark
    # (Spark's model for stateful operators), so the late row comes third.
    src = f"{scratch}/landing"
    day2 = 60 * 24
    land(spark, f"{src}/f=1", [ev(1, 10), ev(2, 20), ev(3, day2 + 360)])  # watermark -> day 2, 05:00
    land(spark, f"{src}/f=2", [ev(5, day2 + 400)])
    land(spark, f"{src}/f=3", [ev(4, 30), ev(6, 3 * day2 + 120)])  # 4 is late for day 1: dropped
    events.daily_counts(spark, src, f"{scratch}/out", f"{scratch}/ckpt", mode="append", max_files=1)
    got = dict((str(r.day), r.n) for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got["2024-01-01"] == 2
    assert got.get("2024-01-02", 2) == 2


def test_stream_queries_read_folder_form_tables(spark, scratch):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.001"
    import os

    if not os.path.isdir(sf):
        return
    # the events table stored as a folder of files instead of one file
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(f"{scratch}/sf/events.parquet")
    n = spark.read.parquet(f"{sf}/events.parquet").count()
    assert queries()["stream_ingest_events"](spark, f"{scratch}/sf").count() == n
    assert queries()["stream_daily_counts"](spark, f"{scratch}/sf").agg({"n": "sum"}).first()[0] == n


def test_replayed_epoch_overwrites_its_output(spark, scratch):
    import os

    src = f"{scratch}/landing"
    land(spark, f"{src}/f=1", [ev(1, 0), ev(2, 1), (3, None, 1, "click", 1.0, "{}")])
    events.ingest(spark, src, f"{scratch}/out", f"{scratch}/ckpt", "b1")
    before = sorted(r.event_id for r in events.read_ingested(spark, f"{scratch}/out").collect())
    files = lambda: sorted(
        f for _, _, fs in os.walk(f"{scratch}/out") for f in fs if f.endswith(".parquet")
    )
    first_files = files()
    # crash after the epoch's output was written, before its commit was recorded
    commits = f"{scratch}/ckpt/commits"
    for name in os.listdir(commits):
        os.remove(os.path.join(commits, name))
    events.ingest(spark, src, f"{scratch}/out", f"{scratch}/ckpt", "b1")  # Spark replays the epoch
    after = sorted(r.event_id for r in events.read_ingested(spark, f"{scratch}/out").collect())
    assert before == after == [1, 2]
    assert files() != first_files  # the epoch really ran again and rewrote its folder
    assert events.read_ingested(spark, f"{scratch}/out", "rejected").count() == 1


def test_dedup_reads_no_earlier_rows(spark, scratch):
    """Twenty epochs: each reads its own file and touches the state of its own ids only."""
    from strata.streaming.runlog import read_progress

    src = f"{scratch}/landing"
    for k in range(20):  # five new ids and a redelivery of the first epoch's, on another day
        land(spark, f"{src}/f={k:02d}", [ev(100 * k + i, 3 * k) for i in range(5)] + [ev(1, 60 * 24 * k)])
    events.dedup(spark, src, f"{scratch}/out", f"{scratch}/ckpt", max_files=1, log_dir=f"{scratch}/progress")
    out = events.read_deduplicated(spark, f"{scratch}/out").collect()
    assert sorted(r.event_id for r in out) == sorted(100 * k + i for k in range(20) for i in range(5))
    log = {r.epoch: r for r in read_progress(spark, f"{scratch}/progress").collect()}
    assert [log[k].input_rows for k in range(20)] == [6] * 20
    assert [log[k].state_rows_updated for k in range(20)] == [5] + [6] * 19
    assert log[19].state_rows == 100


def test_bounded_dedup_frees_state(spark, scratch):
    from strata.streaming.runlog import read_progress

    src, day = f"{scratch}/landing", 60 * 24
    for k in range(6):
        land(spark, f"{src}/f={k}", [ev(k, day * k), ev(k, day * k + 1), ev(max(k - 1, 0), day * k - day + 2)])
    events.dedup(
        spark, src, f"{scratch}/out", f"{scratch}/ckpt", max_files=1, horizon="2 days", log_dir=f"{scratch}/progress"
    )
    assert sorted(r.event_id for r in events.read_deduplicated(spark, f"{scratch}/out").collect()) == list(range(6))
    assert max(r.state_rows for r in read_progress(spark, f"{scratch}/progress").collect()) < 6


def _accounted(spark, scratch, deliveries):
    src = f"{scratch}/landing"
    for k, rows in enumerate(deliveries):
        land(spark, f"{src}/f={k}", rows)
    events.accounted_days(spark, src, f"{scratch}/out", f"{scratch}/ckpt", max_files=1)
    return {r.epoch: r for r in events.read_log(spark, f"{scratch}/out").collect()}


def test_every_row_is_counted_late_or_undated(spark, scratch):
    day = 60 * 24
    deliveries = [
        [ev(1, 10), ev(2, 20), ev(3, day + 360)],
        [ev(4, 30), ev(5, day + 400), (6, None, 1, "click", 1.0, "{}")],  # 4: its day is closed
        [ev(7, day - 1), ev(8, 3 * day + 120), ev(9, day + 1)],
        [ev(10, day + 2), ev(11, 3 * day + 30)],
    ]
    log = _accounted(spark, scratch, deliveries)
    assert [(r.rows_in, r.counted, r.late, r.undated) for _, r in sorted(log.items())] == [
        (3, 3, 0, 0), (3, 1, 1, 1), (3, 2, 1, 0), (2, 1, 1, 0),
    ]
    assert all(log[k].batch_millis > 0 for k in range(4))  # as the listener saw them
    assert sorted((r.epoch, r.event_id) for r in events.read_late(spark, f"{scratch}/out").collect()) == [(1, 4), (2, 7), (3, 10)]
    closed = sorted((str(r.day), r.n) for r in events.read_closed_days(spark, f"{scratch}/out").collect())
    assert closed == [("2024-01-01", 2), ("2024-01-02", 3)]
    assert [log[k].days_closed for k in range(4)] == [1, 0, 1, 0]


def test_accounted_days_equal_brute_force(spark, scratch):
    import random

    rnd, day = random.Random(4), 60 * 24
    deliveries = [
        [ev(1000 * k + i, max(0, day * k + rnd.randint(-2 * day, day)), rnd.choice(["click", "view"])) for i in range(40)]
        for k in range(6)
    ]
    log = _accounted(spark, scratch, deliveries)
    counts, late, mark = {}, [], dt.datetime.min
    for k, rows in enumerate(deliveries):
        for i, ts, _, kind, *_ in rows:
            if dt.datetime.combine(ts.date(), dt.time()) + dt.timedelta(days=1) <= mark:
                late.append((k, i))
            else:
                counts[ts.date(), kind] = counts.get((ts.date(), kind), 0) + 1
        mark = max([mark, *[r[1] - dt.timedelta(hours=1) for r in rows]])
    closed = {(d, kind, n) for (d, kind), n in counts.items() if dt.datetime.combine(d, dt.time()) + dt.timedelta(days=1) <= mark}
    assert len(late) > 10 and all(r.rows_in == r.counted + r.late + r.undated for r in log.values())
    assert {(r.day, r.event_type, r.n) for r in events.read_closed_days(spark, f"{scratch}/out").collect()} == closed
    assert sorted((r.epoch, r.event_id) for r in events.read_late(spark, f"{scratch}/out").collect()) == sorted(late)


def test_replayed_accounting_changes_nothing(spark, scratch):
    import os

    day = 60 * 24
    log = _accounted(spark, scratch, [[ev(1, 10), ev(2, day + 90)], [ev(3, 5), ev(4, 2 * day + 70)]])
    for name in ("1", ".1.crc"):
        os.remove(f"{scratch}/ckpt/commits/{name}")
    events.accounted_days(spark, f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ckpt", max_files=1)
    again = {r.epoch: r for r in events.read_log(spark, f"{scratch}/out").collect()}
    assert [(r.rows_in, r.counted, r.late, r.days_closed) for r in again.values()] == [
        (r.rows_in, r.counted, r.late, r.days_closed) for r in log.values()
    ]
    assert [r.event_id for r in events.read_late(spark, f"{scratch}/out").collect()] == [3]
