"""The five job entry points, end to end on files (no broker, no database)."""

from devicelens import fixtures as fx
import pytest

from devicelens.jobs import JOBS, parse
from devicelens.registry import _messages

from conftest import SF_SMALL


def run(spark, argv):
    opts = parse(argv)
    JOBS[opts.job](spark, opts, opts.args)


def test_jobs_end_to_end(spark, tmpdir_path, capsys):
    src, path, ckpt = tmpdir_path + "/in", tmpdir_path + "/readings", tmpdir_path + "/ckpt"
    _messages(fx.event_readings(spark, SF_SMALL)).write.json(src)
    run(spark, ["ingest", "--path", path, "--checkpoint", ckpt, "--files", src, "--available-now",
                "--time-source", "record"])
    assert spark.read.parquet(path).count() == fx.event_readings(spark, SF_SMALL).count()
    s, e = str(fx.START_MS), str(fx.END_MS)
    run(spark, ["data-analysis", "--path", path, "--print", "-1", "-1", "-1", s, e, "10"])
    out = capsys.readouterr().out
    assert "-1_data" in out and "Statistics" in out and '"status":"success"' in out
    run(spark, ["device-analysis", "--path", path, "--print", "7", s, e])
    out = capsys.readouterr().out
    assert "7_device" in out and "deviceCount" in out
    run(spark, ["recent-data", "--path", path, "--print", e])
    assert "usual_data_rate" in capsys.readouterr().out
    run(spark, ["recent-device", "--path", path, "--print", e, "3"])
    assert "device_count" in capsys.readouterr().out


def test_job_on_reference_text_layout(spark, tmpdir_path, capsys):
    from pyspark.sql import functions as F

    from devicelens.schema import HOUR_END
    from devicelens.sources import format_reading_lines

    r = fx.event_readings(spark, SF_SMALL)
    h = 3_600_000
    # one text folder per hourly window, named by the window end, as the reference writes
    hours = r.withColumn(HOUR_END, (F.col("time_stamp") / h).cast("bigint") * h + h)
    root = tmpdir_path + "/text"
    for row in hours.select(HOUR_END).distinct().orderBy(HOUR_END).limit(30).collect():
        T = row[HOUR_END]
        format_reading_lines(hours.where(F.col(HOUR_END) == T)).coalesce(1).write.text(f"{root}/device-data-{T}")
    s, e = str(fx.START_MS), str(fx.START_MS + 86_400_000)
    run(spark, ["data-analysis", "--path", root, "--layout", "text", "--print", "-1", "-1", "-1", s, e, "4"])
    assert '"status":"success"' in capsys.readouterr().out


@pytest.mark.parametrize("argv", [["ingest", "--path", "p", "--checkpoint", "c"],
                                  ["ingest", "--path", "p", "--files", "f"]])
def test_ingest_arguments_checked(argv):
    with pytest.raises(SystemExit):
        parse(argv)


def test_print_overrides_targets(spark, monkeypatch, capsys):
    from devicelens import jobs

    def refuse(*a, **k):
        raise AssertionError("delivered")

    monkeypatch.setattr(jobs, "write_kafka", refuse)
    monkeypatch.setattr(jobs, "append_recent", refuse)
    opts = parse(["recent-data", "--path", "p", "--kafka", "h:1", "--jdbc-url", "jdbc:x", "--print"])
    rows = spark.createDataFrame([(i, float(i)) for i in range(45)], "tenant_id long, value double")
    jobs._deliver_rows(rows, "t", 0, opts)
    out = capsys.readouterr().out
    assert len(out.strip().splitlines()) == 46  # a heading and every row
    jobs._deliver_report(spark.createDataFrame([("{}",)], "value string"), None, "data", opts)
    assert "-1_data" in capsys.readouterr().out


def test_kafka_options_reach_source_and_sink(spark, monkeypatch):
    from devicelens import jobs

    opts = parse(["data-analysis", "--path", "p", "--kafka", "h:1", "--kafka-option", "kafka.acks=all", "--kafka-option", "a=b=c"])
    seen = []
    monkeypatch.setattr(jobs, "write_kafka", lambda records, servers, options: seen.append((servers, options)))
    jobs._deliver_report(spark.createDataFrame([("{}",)], "value string"), None, "data", opts)
    assert seen == [("h:1", {"kafka.acks": "all", "a": "b=c"})]


@pytest.mark.parametrize("tenant", ["1_000", " 7 ", "007", "+7", "x", "1" * 30])
def test_tenant_matches_as_text(spark, tenant):
    from devicelens.operators import filter_identity

    df = spark.createDataFrame([(7,), (1000,)], "tenant_id long")
    assert filter_identity(df, tenant_id=tenant).count() == 0
    assert filter_identity(df, tenant_id="7").count() == filter_identity(df, tenant_id=7).count() == 1


def test_convert_text_layout(spark, tmpdir_path):
    from devicelens.schema import READING_FIELDS
    from devicelens.sources import format_reading_lines, read_hours

    r = fx.event_readings(spark, SF_SMALL)
    root, out = tmpdir_path + "/text", tmpdir_path + "/table"
    ends = [fx.START_MS + 10 * 86_400_000, fx.START_MS + 40 * 86_400_000]
    for half, end in enumerate(ends):
        format_reading_lines(r.where(f"pmod(time_stamp, 2) = {half}")).write.text(f"{root}/device-data-{end}")
    run(spark, ["convert", "--path", root, "--out", out])
    got = read_hours(spark, out, fx.START_MS, fx.END_MS)
    assert got.select(READING_FIELDS).exceptAll(r.select(READING_FIELDS)).count() == 0 and got.count() == r.count()
    assert {x.hour_end_ms for x in got.select("hour_end_ms").distinct().collect()} == set(ends)


def test_ingest_keeps_late_rows_and_compacts(spark, tmpdir_path, capsys):
    from devicelens.schema import HOUR_END
    from devicelens.sources import read_hours

    src, path, late = tmpdir_path + "/in", tmpdir_path + "/readings", tmpdir_path + "/late"
    _messages(fx.event_readings(spark, SF_SMALL)).write.json(src)
    run(spark, ["ingest", "--path", path, "--checkpoint", tmpdir_path + "/ckpt", "--files", src, "--available-now",
                "--time-source", "record", "--late", late])
    n = fx.event_readings(spark, SF_SMALL).count()
    hours = spark.read.parquet(path).select(HOUR_END).distinct().count()
    assert spark.read.parquet(path).count() == n
    run(spark, ["compact", "--path", path])
    assert f"{hours - 2} hours compacted" in capsys.readouterr().out
    s, e = str(fx.START_MS), str(fx.END_MS)
    assert read_hours(spark, path, int(s), int(e)).count() == n
    run(spark, ["data-analysis", "--path", path, "--late", late, "--print", "-1", "-1", "-1", s, e, "10"])
    assert '"status":"success"' in capsys.readouterr().out


def test_ingest_in_sessions(spark, tmpdir_path):
    from devicelens.storage import load_snapshot

    src, path = tmpdir_path + "/in", tmpdir_path + "/readings"
    _messages(fx.event_readings(spark, SF_SMALL)).write.json(src)
    run(spark, ["ingest", "--path", path, "--checkpoint", tmpdir_path + "/ckpt", "--files", src, "--available-now",
                "--time-source", "record", "--session-hours", "1"])
    assert load_snapshot(spark, path).owners()
