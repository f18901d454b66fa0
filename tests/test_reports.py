"""JSON reports (O18, O19) and sinks."""

import json
import math

from devicelens.operators import bucket_stats, device_type_stats, recent_data
from devicelens.operators.report import bucket_report, device_report
from devicelens.sinks import publish_report, recent_rows, report_topic

S = 1_000_000
E = S + 1000


def test_bucket_report_text(readings):
    df = readings([(1, "t", "d", 1.0, S), (1, "t", "d", 3.0, S + 1), (1, "t", "d", 2.0, S + 600)])
    text = bucket_report(bucket_stats(df, S, E, 2)).first().value
    assert text == (
        '{"status":"success","data":[{"1000000":3.0,"1000500":2.0},{"1000000":1.0,"1000500":2.0},'
        '{"1000000":2.0,"1000500":2.0},{"1000000":1.0,"1000500":0.0},{"1000000":2,"1000500":1},'
        '{"1000000":2,"1000500":1},{"1000000":1.0,"1000500":1.0}]}'
    )
    assert json.loads(text)["status"] == "success"


def test_device_report_text(readings):
    df = readings([(1, "t", "a", 1.0, S), (1, "t", "b", 3.0, S), (1, "u", "a", 2.0, S)])
    text = device_report(device_type_stats(df, S, E)).first().value
    assert text == (
        '{"status":"success","data":{"deviceCount":{"t":2,"u":1},"dataCount":{"t":2,"u":1},'
        '"usualDataCount":{"t":2,"u":1},"usualDataRate":{"t":1.0,"u":1.0}}}'
    )


def test_reports_without_data(readings):  # E8
    df = readings([(1, "t", "a", 1.0, S)])
    assert bucket_report(bucket_stats(df, E, S, 3)).first().value == '{"status":"No Matching Data"}'
    assert device_report(device_type_stats(df, E, E + 5)).first().value == '{"status":"No Matching Data"}'


def test_publish_records(readings):
    df = readings([(1, "t", "a", 1.0, S)])
    rec = publish_report(bucket_report(bucket_stats(df, S, E)), tenant_id=None, kind="data").first()
    assert (rec.topic, rec.key) == ("-1_data", "Statistics")
    assert report_topic(42, "device") == "42_device"


def test_recent_rows_nan_and_date(readings):
    df = readings([(1, "t", "a", float("nan"), S), (1, "t", "a", 1.0, S + 1), (1, "u", "b", 2.0, S)])
    out = {r.device_type: r for r in recent_rows(recent_data(df, 86_400_000 * 3, 3), 86_400_000 * 3).collect()}
    assert str(out["u"].date) == "1970-01-04"
    for v in out["u"].asDict().values():
        assert not (isinstance(v, float) and math.isnan(v))


def test_append_recent_writes_prepared_rows(readings, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from devicelens.sinks import append_recent

    seen = {}

    def fake_jdbc(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, properties=properties,
                    rows=[r.asDict() for r in self._df.collect()])

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    df = readings([(1, "t", "a", 1.0, S), (1, "t", "a", 3.0, S + 1)])
    end = 86_400_000 * 2
    append_recent(recent_data(df, end, 2), "jdbc:postgresql://db/x", "recent_data", end, {"user": "u"})
    assert (seen["url"], seen["table"], seen["mode"]) == ("jdbc:postgresql://db/x", "recent_data", "append")
    assert seen["properties"]["user"] == "u" and seen["properties"]["batchsize"] == "1000"
    assert seen["properties"]["numPartitions"] == "8"
    (row,) = seen["rows"]
    assert row["data_count"] == 2 and str(row["date"]) == "1970-01-03"


def test_write_kafka_uses_spark_sink(readings, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from devicelens.sinks import write_kafka

    seen = {"options": {}}
    real_format, real_option = DataFrameWriter.format, DataFrameWriter.option

    def fake_format(self, source):
        seen["format"] = source
        return real_format(self, source)

    def fake_option(self, key, value):
        seen["options"][key] = value
        return real_option(self, key, value)

    def fake_save(self, *a, **k):
        seen["rows"] = [tuple(r) for r in self._df.collect()]

    monkeypatch.setattr(DataFrameWriter, "format", fake_format)
    monkeypatch.setattr(DataFrameWriter, "option", fake_option)
    monkeypatch.setattr(DataFrameWriter, "save", fake_save)
    df = readings([(1, "t", "a", 1.0, S)])
    records = publish_report(bucket_report(bucket_stats(df, S, E)), tenant_id=1, kind="data")
    write_kafka(records, "broker:9092")
    assert seen["format"] == "kafka" and seen["options"]["kafka.bootstrap.servers"] == "broker:9092"
    ((topic, key, value),) = seen["rows"]
    assert (topic, key) == ("1_data", "Statistics") and value.startswith('{"status":"success"')
