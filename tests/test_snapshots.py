"""Compacted and live hours as one snapshot, a bounded commit log, what may be deleted."""

import datetime as dt
import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from devicelens.schema import DAY_MS, HOUR_END, READING_FIELDS
from devicelens.sources import read_hours
from devicelens.sources.hours import live_hours
from devicelens.sources.messages import message_file_stream, message_records
from devicelens.storage import Generation, load_snapshot, publish
from devicelens.streaming import run_ingest, write_hourly_readings_batch
from devicelens.streaming.compaction import (
    closed_hours, compact_table, log_retention, merge_generations, remove_compacted, write_generation,
)

H = 3_600_000
T0 = dt.datetime(2024, 1, 1, 0, 10)
ALL = (0, 1 << 52)


def message(device, value, ms):
    return json.dumps({"tenantId": 1, "deviceId": device, "data": [{"key": "t", "value": value, "ts": ms}]})


def send(spark, src, records):
    spark.createDataFrame(records, "value string, ingest_ts timestamp").coalesce(1).write.mode("append").json(src)


def hours_of(k, n=3, late=0):
    """n messages of hour k; ``late`` of them have a reading of ten days before."""
    at = T0 + dt.timedelta(hours=k)
    ms = int(at.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return [(message(f"d{i}", float(k * 100 + i), ms + i - (10 * DAY_MS if i < late else 0)), at + dt.timedelta(seconds=i)) for i in range(n)]


def ingest(spark, d, **options):
    records = message_records(message_file_stream(spark, f"{d}/in"), "value", "ingest_ts")
    run_ingest(records, f"{d}/t", f"{d}/ckpt", trigger={"availableNow": True}, time_source="record", state_partitions=2, **options).awaitTermination()


def content(spark, path, start=ALL[0], end=ALL[1]):
    return sorted(tuple(r) for r in read_hours(spark, path, start, end).select(*READING_FIELDS, HOUR_END).collect())


def test_snapshot_of_compacted_and_live_hours(spark, tmpdir_path):
    d, t = tmpdir_path, f"{tmpdir_path}/t"
    send(spark, f"{d}/in", [r for k in range(4) for r in hours_of(k, late=1)])
    ingest(spark, d)
    whole = content(spark, t)
    assert len(whole) == 12
    # the newest hour and what the watermark has not passed stay open
    newest = max(r[-1] for r in whole)
    assert closed_hours(spark, t) == [newest - 3 * H, newest - 2 * H, newest - H]
    assert closed_hours(spark, t, 300_000) == [newest - 3 * H, newest - 2 * H]
    compact_table(spark, t, 300_000)
    assert content(spark, t) == whole and load_snapshot(spark, t).version == 1
    # a compaction that is lost before it publishes is not seen, and simply run again
    rows = live_hours(spark, t).where(F.col(HOUR_END) == newest - H)
    write_generation(rows.unionByName(rows.withColumn("value", F.lit(-1.0))), t)
    assert content(spark, t) == whole
    # the table goes on
    send(spark, f"{d}/in", hours_of(3) + hours_of(4, n=5))
    ingest(spark, d)
    whole = content(spark, t)
    assert len(whole) == 12 + 1 + 5  # hour 3: the reading of ten days before is another one now
    compact_table(spark, t, 300_000)
    snapshot = load_snapshot(spark, t)
    assert snapshot.version == 2 and [len(g.hours) for g in snapshot.generations] == [2, 1]
    assert content(spark, t) == whole
    # ranges read only their days, wherever the hours lie
    day = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000) // DAY_MS
    old = content(spark, t, (day - 10) * DAY_MS, (day - 9) * DAY_MS - 1)
    assert len(old) == 4 and old == [r for r in whole if r[4] < (day - 9) * DAY_MS]
    files = read_hours(spark, t, (day - 10) * DAY_MS, (day - 9) * DAY_MS - 1)
    assert all("=-1/" in f or f"event_day={day - 10}/" in f for f in files.where("event_day > 0").inputFiles() if "_compacted" in f)
    merged = merge_generations(spark, t, newest)
    assert [len(g.hours) for g in merged.generations] == [3] and content(spark, t) == whole


def test_partly_superseded_generation(spark, readings, tmpdir_path):
    t = f"{tmpdir_path}/t"
    rows = readings([(1, "t", "d", float(k), k * H) for k in range(6)]).withColumn(HOUR_END, F.col("time_stamp") + H)
    write_hourly_readings_batch(rows, t)
    whole = content(spark, t)
    first = compact_table(spark, t)
    assert first.generations[0].hours == [H * k for k in range(1, 6)]
    again = write_generation(live_hours(spark, t).where(F.col(HOUR_END).isin([2 * H, 3 * H])), t)
    again.hours = [2 * H, 3 * H]
    now = publish(spark, t, first, again)
    assert [g.hours for g in now.generations] == [[H, 4 * H, 5 * H], [2 * H, 3 * H]] and now.generations[0].superseded == [2 * H, 3 * H]
    assert content(spark, t) == whole
    merge_generations(spark, t, 100 * H)
    assert content(spark, t) == whole


def test_two_compactions_at_once(spark, readings, tmpdir_path):
    t = f"{tmpdir_path}/t"
    rows = readings([(1, "t", "d", float(k), k * H) for k in range(4)]).withColumn(HOUR_END, F.col("time_stamp") + H)
    write_hourly_readings_batch(rows, t)
    base, whole = load_snapshot(spark, t), content(spark, t)
    a, b, c = (write_generation(live_hours(spark, t).where(F.col(HOUR_END) == h), t) for h in (H, 2 * H, H))
    a.hours, b.hours, c.hours = [H], [2 * H], [H]
    publish(spark, t, base, a)
    assert publish(spark, t, base, b).version == 2  # other hours: on top of the first
    with pytest.raises(RuntimeError, match="another compaction"):
        publish(spark, t, base, c)
    assert content(spark, t) == whole and len(load_snapshot(spark, t).generations) == 2
    assert publish(spark, t, load_snapshot(spark, t), Generation("x", [], [])).version == 3


def test_log_lets_compacted_entries_go_only(spark, tmpdir_path):
    """The log's old entries go, those of open hours never, and every count stays."""
    d, t, interval = tmpdir_path, f"{tmpdir_path}/t", "spark.sql.streaming.fileSink.log.compactInterval"
    session = 10_000  # longer than any run here takes
    spark.conf.set(interval, "2")
    try:
        for k in range(4):
            send(spark, f"{d}/in", hours_of(k))
            ingest(spark, d)
        whole, listed = content(spark, t), len(live_hours(spark, t).inputFiles())
        # nothing is compacted: the retention covers the oldest file, so no entry goes
        time.sleep(session / 1000)
        ingest(spark, d, retention=log_retention(spark, t, session))
        for k in (4, 5):
            send(spark, f"{d}/in", hours_of(k))
            ingest(spark, d, retention=log_retention(spark, t, session))
        assert len(live_hours(spark, t).inputFiles()) > listed
        assert content(spark, t) == sorted(whole + [r for r in content(spark, t) if r not in whole]) and len(content(spark, t)) == 18
        compact_table(spark, t, 300_000)
        done = set(load_snapshot(spark, t).owners())
        assert len(done) == 4
        assert remove_compacted(spark, t, keep_ms=0)["hours"] == []  # the log still lists them
        time.sleep(session / 1000)
        for k in range(6, 10):
            send(spark, f"{d}/in", hours_of(k))
            ingest(spark, d, retention=log_retention(spark, t, session))
            assert len(content(spark, t)) == 3 * (k + 1)
        left = {int(f.split("hour_end_ms=")[1].split("/")[0]) for f in live_hours(spark, t).inputFiles()}
        assert not left & done and len(left) == 6
        gone = remove_compacted(spark, t, keep_ms=0)
        assert set(gone["hours"]) == done
        assert not any(glob.glob(f"{t}/event_day=*/hour_end_ms={h}") for h in done)
        assert len(content(spark, t)) == 30 and len(set(content(spark, t))) == 30
    finally:
        spark.conf.unset(interval)


def test_remove_lost_generations_after_their_grace(spark, readings, tmpdir_path):
    t = f"{tmpdir_path}/t"
    rows = readings([(1, "t", "d", float(k), k * H) for k in range(3)]).withColumn(HOUR_END, F.col("time_stamp") + H)
    write_hourly_readings_batch(rows, t)
    lost = write_generation(live_hours(spark, t), t)
    compact_table(spark, t)
    whole = content(spark, t)
    assert remove_compacted(spark, t) == {"hours": [], "generations": []}
    later = int(time.time() * 1000) + 2 * DAY_MS
    assert remove_compacted(spark, t, now_ms=later) == {"hours": [H, 2 * H], "generations": [lost.id]}
    assert content(spark, t) == whole and not os.path.exists(f"{t}/_compacted/generation={lost.id}")
    write_hourly_readings_batch(rows.withColumn(HOUR_END, F.col(HOUR_END) + 9 * H), t)
    compact_table(spark, t)
    assert len(content(spark, t)) == 6 and len(load_snapshot(spark, t).generations) == 2


def test_sessions_compact_between_queries(spark, tmpdir_path):
    from devicelens.streaming.ingest import run_ingest_sessions

    d, t = tmpdir_path, f"{tmpdir_path}/t"
    send(spark, f"{d}/in", [r for k in range(3) for r in hours_of(k)])
    records = message_records(message_file_stream(spark, f"{d}/in"), "value", "ingest_ts")
    options = dict(time_source="record", state_partitions=2)
    run_ingest_sessions(records, t, f"{d}/ckpt", 60_000, trigger={"availableNow": True}, delay_ms=300_000, **options)
    assert len(content(spark, t)) == 9 and len(load_snapshot(spark, t).owners()) == 1
    send(spark, f"{d}/in", [r for k in range(3, 6) for r in hours_of(k)])
    run_ingest_sessions(records, t, f"{d}/ckpt", 6_000, trigger={"processingTime": "1 second"}, delay_ms=300_000, sessions=2, **options)
    assert len(content(spark, t)) == 18 and len(load_snapshot(spark, t).owners()) == 4
