"""Hourly de-duplication (E11), stream = batch, late data."""

import json

from pyspark.sql import functions as F

from devicelens import fixtures as fx
from devicelens.operators.dedup import hourly_distinct_readings
from devicelens.registry import _messages
from devicelens.schema import HOUR_END, READING_FIELDS
from devicelens.sources import parse_device_messages
from devicelens.sources.messages import message_file_stream, message_records
from devicelens.streaming import run_ingest

from conftest import SF_SMALL

H = 3_600_000


def test_dedup_within_and_across_hours(spark, readings):  # E11
    from devicelens.functions.timecols import ms_to_ts

    r = readings([(1, "t", "d", 1.0, 10), (1, "t", "d", 1.0, 10), (1, "t", "d", 2.0, 10)])
    a = r.withColumn("ingest_ts", ms_to_ts(F.lit(5 * H + 10)))
    b = r.withColumn("ingest_ts", ms_to_ts(F.lit(6 * H + 10)))
    out = hourly_distinct_readings(a.unionByName(b), "ingest_ts")
    got = sorted((x.value, x[HOUR_END]) for x in out.collect())
    assert got == [(1.0, 6 * H), (1.0, 7 * H), (2.0, 6 * H), (2.0, 7 * H)]


def _write_messages(spark, path, records):
    spark.createDataFrame(records, "value string, ingest_ts timestamp").coalesce(1).write.mode("append").json(path)


def test_stream_equals_batch(spark, tmpdir_path):
    msgs = _messages(fx.event_readings(spark, SF_SMALL))
    src = tmpdir_path + "/in"
    msgs.write.json(src)
    q = run_ingest(message_records(message_file_stream(spark, src), "value", "ingest_ts"),
                   tmpdir_path + "/out", tmpdir_path + "/ckpt", trigger={"availableNow": True}, time_source="record")
    q.awaitTermination()
    streamed = spark.read.parquet(tmpdir_path + "/out").select(*READING_FIELDS, HOUR_END)
    batch = hourly_distinct_readings(
        parse_device_messages(spark.read.json(src, schema="value string, ingest_ts timestamp"),
                              keep=("ingest_ts",)), "ingest_ts").select(*READING_FIELDS, HOUR_END)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_late_rows_dropped_after_watermark(spark, tmpdir_path):  # D5
    import datetime as dt

    def message(v, ms):
        return json.dumps({"tenantId": 1, "deviceId": "d", "data": [{"key": "t", "value": v, "ts": ms}]})

    t0 = dt.datetime(2024, 1, 1, 10, 30)
    src = tmpdir_path + "/in"
    _write_messages(spark, src, [(message(1.0, 1), t0), (message(1.0, 1), t0)])
    records = message_records(message_file_stream(spark, src, max_files_per_trigger=1), "value", "ingest_ts")
    out, ckpt = tmpdir_path + "/out", tmpdir_path + "/ckpt"
    run_ingest(records, out, ckpt, trigger={"availableNow": True}, time_source="record").awaitTermination()
    # Second batch: a copy and a new row, both ingested in an hour the watermark
    # (10:25) has closed, and one row in the open hour.
    late = dt.datetime(2024, 1, 1, 9, 10)
    _write_messages(spark, src, [(message(1.0, 1), late), (message(2.0, 2), late), (message(3.0, 3), t0)])
    run_ingest(records, out, ckpt, trigger={"availableNow": True}, time_source="record").awaitTermination()
    got = sorted(x.value for x in spark.read.parquet(out).collect())
    assert got == [1.0, 3.0]


def test_state_partitions_fixed_for_stream_only(spark, tmpdir_path):
    msgs = _messages(fx.event_readings(spark, SF_SMALL))
    src = tmpdir_path + "/in"
    msgs.write.json(src)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q = run_ingest(message_records(message_file_stream(spark, src), "value", "ingest_ts"),
                   tmpdir_path + "/out", tmpdir_path + "/ckpt", trigger={"availableNow": True}, state_partitions=3)
    q.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    states = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert states and all(s["numShufflePartitions"] == 3 for s in states)
    assert spark.read.parquet(tmpdir_path + "/out").count() == fx.event_readings(spark, SF_SMALL).count()


def test_kafka_source_wiring(spark, tmpdir_path, monkeypatch):
    from pyspark.sql.streaming.readwriter import DataStreamReader

    from devicelens.sources import stream_device_messages

    seen = {"options": {}}
    real_format, real_option = DataStreamReader.format, DataStreamReader.option
    src = tmpdir_path + "/in"
    spark.createDataFrame([("x", None)], "value string, timestamp timestamp").write.json(src)

    def fake_format(self, source):
        seen["format"] = source
        return real_format(self, source)

    def fake_option(self, key, value):
        seen["options"][key] = value
        return real_option(self, key, value)

    def fake_load(self, *a, **k):  # no Kafka connector here: a file stream with Kafka's columns
        return spark.readStream.schema("value binary, timestamp timestamp").json(src)

    monkeypatch.setattr(DataStreamReader, "format", fake_format)
    monkeypatch.setattr(DataStreamReader, "option", fake_option)
    monkeypatch.setattr(DataStreamReader, "load", fake_load)
    df = stream_device_messages(spark, "broker:9092", options={"maxOffsetsPerTrigger": "100000"})
    assert seen["format"] == "kafka"
    assert seen["options"] == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "deviceData",
                               "startingOffsets": "latest", "maxOffsetsPerTrigger": "100000"}
    assert df.isStreaming and [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("value", "string"), ("ingest_ts", "timestamp")]


def test_processing_time_keeps_every_row(spark, tmpdir_path):
    """Default time source: the batch's hour; copies in a batch collapse and
    nothing is late, whatever the records' own timestamps say."""
    import datetime as dt
    import time

    def message(v, ms):
        return json.dumps({"tenantId": 1, "deviceId": "d", "data": [{"key": "t", "value": v, "ts": ms}]})

    old = dt.datetime(2020, 1, 1)
    src = tmpdir_path + "/in"
    _write_messages(spark, src, [(message(1.0, 1), old), (message(1.0, 1), old), (message(2.0, 2), None)])
    records = message_records(message_file_stream(spark, src, max_files_per_trigger=1), "value", "ingest_ts")
    out, ckpt = tmpdir_path + "/out", tmpdir_path + "/ckpt"
    before = int(time.time() * 1000)
    run_ingest(records, out, ckpt, trigger={"availableNow": True}).awaitTermination()
    _write_messages(spark, src, [(message(3.0, 3), old)])  # would be far behind a record watermark
    run_ingest(records, out, ckpt, trigger={"availableNow": True}).awaitTermination()
    after = int(time.time() * 1000)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.value for r in rows) == [1.0, 2.0, 3.0]
    for r in rows:
        assert before < r[HOUR_END] <= after - after % H + H


def test_print_stream_shows_records(spark, tmpdir_path):
    from devicelens.streaming import print_stream

    src = tmpdir_path + "/in"
    _write_messages(spark, src, [(json.dumps({"tenantId": 1, "deviceId": "dbg", "data": []}), None)])
    q = print_stream(message_records(message_file_stream(spark, src), "value", "ingest_ts"),
                     trigger={"availableNow": True})
    q.awaitTermination()
    # the JVM prints the batch to its own stdout; check what the query consumed and where it went
    progress = [p for p in q.recentProgress if p["numInputRows"]]
    assert sum(p["numInputRows"] for p in progress) == 1
    assert "Console" in progress[0]["sink"]["description"]


def test_precombine_collapses_copies_before_the_shuffle(spark, readings):
    from devicelens.functions.timecols import ms_to_ts
    from devicelens.streaming.ingest import precombine_copies

    flood = [(1, "t", "hot", 1.0, 10)] * 3000 + [(1, "t", "d", float(i), 10) for i in range(20)]
    df = readings(flood).coalesce(1).withColumn("ingest_ts", ms_to_ts(F.lit(5 * H + 7)))
    pre = precombine_copies(df)
    batches = -(-len(flood) // int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
    assert pre.where(F.col("device_id") == "hot").count() <= batches
    assert pre.where(F.col("device_id") == "d").count() == 20
    # copies in different ingest hours are different readings to the dedup
    other_hour = readings([(1, "t", "hot", 1.0, 10)]).withColumn("ingest_ts", ms_to_ts(F.lit(6 * H)))
    both = precombine_copies(df.unionByName(other_hour).coalesce(1))
    assert hourly_distinct_readings(both, "ingest_ts").where(F.col("device_id") == "hot").count() == 2


def test_default_ingest_has_no_python_step(spark, tmpdir_path):
    from devicelens.streaming.ingest import readings_stream

    src = tmpdir_path + "/in"
    _write_messages(spark, src, [("{}", None)])
    records = message_records(message_file_stream(spark, src), "value", "ingest_ts")
    assert "InArrow" not in readings_stream(records)._jdf.queryExecution().logical().toString()
    assert "InArrow" in readings_stream(records, precombine=True)._jdf.queryExecution().logical().toString()


def test_nanosecond_message_passes_the_ingest(spark, tmpdir_path):
    src, out = tmpdir_path + "/in", tmpdir_path + "/out"
    el = {"key": "t", "value": 1.0, "ts": 1704067200000000000}
    _write_messages(spark, src, [(json.dumps({"tenantId": 1, "deviceId": "d", "data": [el, el, {**el, "ts": 5}]}), None)])
    records = message_records(message_file_stream(spark, src), "value", "ingest_ts")
    run_ingest(records, out, tmpdir_path + "/ckpt", trigger={"availableNow": True}).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.time_stamp, r.ts is None, r.event_day) for r in rows) == [(5, False, -1), (1704067200000000000, True, -1)]


def test_state_partitions_rule():
    from devicelens.streaming.ingest import state_partitions_for

    assert state_partitions_for(0, 8) == 1
    assert state_partitions_for(3_000_000, 100) == 6
    assert state_partitions_for(100_000_000, 64) == 256


def test_two_batches_are_many_files_each(spark, monkeypatch):
    import glob
    import json

    from devicelens import registry

    paths, events, scratch = {}, registry._events, registry.scratch_path
    monkeypatch.setattr(registry, "_events", lambda *a: events(*a).repartition(4))
    monkeypatch.setattr(registry, "scratch_path", lambda spark, name: paths.setdefault(name, scratch(spark, name)))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # four partitions of few rows stay four
    try:
        out = registry.q_ingest_two_batches(spark, SF_SMALL)
    finally:
        spark.conf.unset(coalesce)
    local = {k: p.removeprefix("file:") for k, p in paths.items()}
    assert len(glob.glob(f"{local['messages']}/part-*.json")) == 8
    batches = [open(p).read().splitlines()[1:] for p in glob.glob(f"{local['hourly-2b-ckpt']}/sources/0/[0-9]*")]
    assert [len(b) for b in batches] == [4, 4] and all("path" in json.loads(x) for b in batches for x in b)
    assert out.count() == out.distinct().count() > 0
