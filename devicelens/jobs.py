"""The reference's five programs as spark-submit entry points.

    spark-submit -m devicelens.jobs ingest --path P --checkpoint C --kafka HOST:PORT
    ... data-analysis  --path P [tenantId deviceType deviceId startTime endTime partNum]
    ... device-analysis --path P [tenantId startTime endTime]
    ... recent-data    --path P [endTime]
    ... recent-device  --path P [endTime days]
    ... convert        --path TEXT --out P
    ... compact        --path P [--delay-minutes N]

Positional arguments and their defaults are the reference's: ``-1`` means
"any" for identities; a negative start is 0, a negative end is now, a part
count <= 0 is 1.  Reports go to Kafka (``--kafka``), rows to a JDBC table
(``--jdbc-url``); with ``--print``, or without a target, they are printed, all
of them.  ``--path`` is the stored hourly readings table written by ``ingest``
or, with ``--layout text``, the folder holding the reference's
``device-data-<ms>`` text output; ``convert`` turns that into the stored table
(run it again for text that has come since), instead of parsing it in every job.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession

from .operators import bucket_stats, device_type_stats, recent_data, recent_device
from .operators.report import bucket_report, device_report
from .schema import ANY_ID, DAY_MS, HOUR_MS, SOURCE_TOPIC
from .session import STATE_STORE, STATE_STORE_CONF, prepare_session
from .sinks import append_recent, publish_report, recent_rows, write_kafka
from .sources import read_hours, read_text_hours
from .sources.messages import message_file_stream, message_records, stream_device_messages
from .streaming import run_ingest
from .streaming.batches import DELAY_MS, run_ingest_batches
from .streaming.compaction import compact_table, remove_compacted
from .streaming.convert import convert_text, read_bad_lines
from .streaming.ingest import DEFAULT_STATE_PARTITIONS, run_ingest_sessions


def _now_ms() -> int:
    return int(time.time() * 1000)


def _arg(args, i, default):
    return args[i] if len(args) > i else default


def _options(pairs) -> dict:
    return dict(kv.split("=", 1) for kv in pairs or [])


def _readings(spark, opts, start, end) -> DataFrame:
    """Readings of the range, scanned again by each pass of an analysis."""
    if opts.layout == "text":
        return read_text_hours(spark, opts.path, start, end, pad_hours=opts.pad_hours)
    return read_hours(spark, opts.path, start, end, late_path=opts.late)


def _print(rows: DataFrame) -> None:
    """Print every row, fetched a partition at a time."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join(map(str, row)))


def _deliver_report(report, tenant, kind, opts):
    records = publish_report(report, tenant_id=tenant, kind=kind)
    if opts.kafka and not opts.print:
        write_kafka(records, opts.kafka, _options(opts.kafka_option))
    else:
        _print(records)


def _deliver_rows(rows, table, end_ms, opts):
    if opts.jdbc_url and not opts.print:
        append_recent(rows, opts.jdbc_url, table, end_ms, _options(opts.jdbc_option))
    else:
        _print(recent_rows(rows, end_ms))


def data_analysis(spark: SparkSession, opts, args) -> None:
    tenant, dtype, device = _arg(args, 0, ANY_ID), _arg(args, 1, ANY_ID), _arg(args, 2, ANY_ID)
    start, end = int(_arg(args, 3, -1)), int(_arg(args, 4, -1))
    parts = int(_arg(args, 5, 1))
    start = 0 if start < 0 else start
    end = _now_ms() if end < 0 else end
    stats = bucket_stats(_readings(spark, opts, start, end), start, end, parts, tenant, dtype, device)
    _deliver_report(bucket_report(stats), tenant, "data", opts)


def device_analysis(spark: SparkSession, opts, args) -> None:
    tenant = _arg(args, 0, ANY_ID)
    start, end = int(_arg(args, 1, -1)), int(_arg(args, 2, -1))
    start = 0 if start < 0 else start
    end = _now_ms() if end < 0 else end
    stats = device_type_stats(_readings(spark, opts, start, end), start, end, tenant)
    _deliver_report(device_report(stats), tenant, "device", opts)


def recent_data_job(spark: SparkSession, opts, args) -> None:
    end = int(_arg(args, 0, _now_ms()))
    rows = recent_data(_readings(spark, opts, end - DAY_MS, end), end, 1)
    _deliver_rows(rows, opts.table or "recent_data", end, opts)


def recent_device_job(spark: SparkSession, opts, args) -> None:
    end, days = int(_arg(args, 0, _now_ms())), int(_arg(args, 1, 1))
    rows = recent_device(_readings(spark, opts, end - days * DAY_MS, end), end, days)
    _deliver_rows(rows, opts.table or "recent_device", end, opts)


def ingest(spark: SparkSession, opts, args) -> None:
    if opts.files:
        records = message_records(message_file_stream(spark, opts.files), "value", "ingest_ts")
    else:
        records = stream_device_messages(spark, opts.kafka, opts.topic, options=_options(opts.kafka_option))
    trigger = {"availableNow": True} if opts.available_now else None
    spark.conf.set(STATE_STORE_CONF, STATE_STORE)  # dedup state off the heap, checkpointed by changes
    if opts.late:
        q = run_ingest_batches(records, opts.path, opts.checkpoint, opts.late, trigger, opts.time_source, opts.delay_minutes * 60_000)
        q.awaitTermination()
        return
    delay = opts.delay_minutes * 60_000 if opts.time_source == "record" else 0
    options = dict(trigger=trigger, time_source=opts.time_source, watermark=f"{opts.delay_minutes} minutes",
                   state_partitions=opts.state_partitions, precombine=opts.precombine)
    if opts.session_hours:
        run_ingest_sessions(records, opts.path, opts.checkpoint, int(opts.session_hours * HOUR_MS), delay, **options)
    else:
        run_ingest(records, opts.path, opts.checkpoint, **options).awaitTermination()


def compact(spark: SparkSession, opts, args) -> None:
    """Closed hours of the stored table into a generation; then what no reader names any more goes."""
    snapshot = compact_table(spark, opts.path, opts.delay_minutes * 60_000)
    gone = remove_compacted(spark, opts.path)
    print(f"version {snapshot.version}: {len(snapshot.owners())} hours compacted; deleted {len(gone['hours'])} live hours "
          f"and {len(gone['generations'])} generations")


def convert(spark: SparkSession, opts, args) -> None:
    """The reference's text layout -> the stored table (its hour is the folder's name); only
    folders that are new or have changed. Bad lines are kept apart, and their number shown."""
    snapshot = convert_text(spark, opts.path, opts.out)
    print(f"version {snapshot.version}: {len(snapshot.owners())} hours, {read_bad_lines(spark, opts.out, snapshot).count()} bad lines")


JOBS = {
    "ingest": ingest,
    "data-analysis": data_analysis,
    "device-analysis": device_analysis,
    "recent-data": recent_data_job,
    "recent-device": recent_device_job,
    "convert": convert,
    "compact": compact,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="devicelens.jobs")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("args", nargs="*", help="the reference's positional arguments")
    p.add_argument("--path", required=True, help="stored hourly readings (Parquet, by event_day and hour_end_ms)")
    p.add_argument("--out", help="table that convert brings up to the text")
    p.add_argument("--pad-hours", type=int,
                   help="text layout: readings arrive at most this late, so read only folders around the range "
                        "(default: read all)")
    p.add_argument("--layout", choices=["parquet", "text"], default="parquet",
                   help="text: the reference's device-data-<ms> comma-text folders")
    p.add_argument("--kafka", help="bootstrap servers: source of ingest, sink of reports")
    p.add_argument("--topic", default=SOURCE_TOPIC)
    p.add_argument("--kafka-option", action="append",
                   help="key=value of Spark's Kafka source or sink (maxOffsetsPerTrigger, kafka.security.protocol, ...)")
    p.add_argument("--precombine", action="store_true",
                   help="ingest: collapse copies across messages before the shuffle, in Python workers")
    p.add_argument("--files", help="ingest from JSON-lines message files instead of Kafka")
    p.add_argument("--checkpoint", help="checkpoint of the ingest query")
    p.add_argument("--available-now", action="store_true", help="ingest what is there, then stop")
    p.add_argument("--state-partitions", type=int, default=DEFAULT_STATE_PARTITIONS,
                   help="dedup state partitions of a new ingest checkpoint (size them to one micro-batch)")
    p.add_argument("--time-source", choices=["processing", "record"], default="processing",
                   help="hour of a reading: when its batch runs (no drops) or its record timestamp")
    p.add_argument("--delay-minutes", type=int, default=DELAY_MS // 60_000,
                   help="ingest by record time, compact: an hour closes this long after its end")
    p.add_argument("--late", help="table of late rows: ingest keeps every row (no state store), analyses read both tables")
    p.add_argument("--session-hours", type=float,
                   help="ingest: stop that often to compact closed hours and shorten the commit log")
    p.add_argument("--jdbc-url")
    p.add_argument("--table")
    p.add_argument("--jdbc-option", action="append", help="key=value JDBC property (user, password, ...)")
    p.add_argument("--print", action="store_true", help="show results instead of delivering them")
    return p


def parse(argv=None):
    p = parser()
    opts = p.parse_intermixed_args(argv)
    if opts.job == "ingest":
        if not (opts.kafka or opts.files):
            p.error("ingest needs --kafka or --files")
        if not opts.checkpoint:
            p.error("ingest needs --checkpoint (offsets and dedup state)")
    if opts.job == "convert" and not opts.out:
        p.error("convert needs --out")
    return opts


def main(argv=None) -> None:
    opts = parse(argv)
    spark = prepare_session(SparkSession.builder.appName(f"devicelens-{opts.job}").getOrCreate())
    JOBS[opts.job](spark, opts, opts.args)


if __name__ == "__main__":
    main()
