"""Registered queries over the driver's tables, with DuckDB oracle SQL.

Every query reads whole tables (``events``, or ``lineitem`` for the larger
variants) through the mapping in :mod:`devicelens.fixtures`; parameters are
the fixed ones of FIXTURES.md.  Means and deviations are rounded in both
engines so that summation order does not matter; all else is compared exactly.

Building a frame can run jobs: statistics that have no static bound are
materialized and measured first, and queries that stream or write do so.

Besides one query per operator, ``*_split`` variants force the strategy that
statistics too large to broadcast take, and the ingest is registered both
with record-time hours (``write_hourly_readings``) and with the default
processing-time hours (``ingest_processing_time``).  Queries that stream or
write use fresh folders inside the session's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixtures as fx
from .operators import (
    assign_time_bucket, bucket_stats, device_type_stats, filter_identity, filter_recent, filter_time_range,
    group_stats, recent_data, recent_device, usual_counts, usual_rate,
)
from .operators.dedup import hourly_distinct_readings
from .operators.report import bucket_report, bucket_report_rows, device_report, device_report_rows
from .schema import BUCKET, DAY_MS, DEVICE, HOUR_END, READING_FIELDS, TENANT, TIME_MS, TYPE, VALUE
from .operators.summaries import (
    bucket_stats_summarised, device_type_stats_summarised, recent_data_summarised, recent_device_summarised,
)
from .session import prepare_session, scratch_path
from .sinks import publish_report, recent_rows
from .sources import (
    format_reading_lines, parse_device_messages, parse_reading_lines, read_hours, read_reading_lines, read_text_hours,
)
from .sources.hours import live_hours
from .sources.lines import TEXT_DIR_PREFIX
from .sources.messages import message_file_stream, message_records
from .sources.summaries import SummarisedTable
from .storage import load_snapshot, small_files
from .streaming import run_ingest, write_hourly_readings_batch
from .streaming.batches import DELAY_MS, run_ingest_batches
from .streaming.compaction import closed_hours, compact_table, write_generation
from .streaming.convert import convert_text, read_bad_lines
from .streaming.ingest import DEFAULT_WATERMARK, compact_hours

S, E, PARTS = fx.START_MS, fx.END_MS, fx.PARTS
GAP = 259_200_000  # bucket_width(S, E, 10)
TYPE_PARTS, TYPE_GAP, TYPE_FILTER = 30, 86_400_000, "purchase"
LI_S, LI_E, LI_PARTS, LI_GAP = 788_918_400_000, 1_009_843_200_000, 12, 18_410_400_000
RANGE_S, RANGE_E = S + 10 * DAY_MS, S + 20 * DAY_MS
HOURS_S, HOURS_E = S + 5 * DAY_MS, S + 6 * DAY_MS
VIEW_TYPE = "view"
REPORT_TENANT = 7
LATE_DAYS = 6


# Largest and smallest values, counts and rates (one division of two counts) are
# the same number in both engines and are compared as they are.  Means and
# deviations depend on the order of summation in the last digits, so both are
# rounded where no mean lies half-way between two results: events have two decimals
# and groups of few readings, whose means end before 9 places; line items (values up
# to 100,000, large groups) are rounded to 1.
DIGITS = 9
LI_DIGITS = 1
ROUNDED = ("mean_value", "stddev_value")


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in ROUNDED if c in df.columns})


def rounded_report(rows: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Report rows (metric, ..., value) with means and deviations rounded."""
    return rows.withColumn("value", F.when(F.col("metric").isin("mean", "stdev"), F.round("value", digits)).otherwise(F.col("value")))


def R(expr: str, digits: int = DIGITS) -> str:
    """The same rounding in DuckDB."""
    return f"round(CAST({expr} AS DOUBLE), {digits})"


def _events(spark, sf_dir):
    prepare_session(spark)
    return fx.event_readings(spark, sf_dir)


def _lineitem(spark, sf_dir):
    prepare_session(spark)
    return fx.lineitem_readings(spark, sf_dir)


def _messages(readings: DataFrame) -> DataFrame:
    """Device messages built from readings: one per device and second, sent
    (ingested) at its last reading."""
    g = readings.groupBy(TENANT, DEVICE, F.expr(f"{TIME_MS} div 1000").alias("_sec")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(TYPE).alias("key"), F.col(VALUE).alias("value"),
                                             F.col(TIME_MS).alias("ts")))).alias("data"),
        F.max(TIME_MS).alias("_last"),
    )
    return g.select(
        F.to_json(F.struct(F.col(TENANT).alias("tenantId"), F.col(DEVICE).alias("deviceId"), "data")).alias("value"),
        F.timestamp_millis("_last").alias("ingest_ts"),
    )


# ---------------------------------------------------------------- queries

def q_bucket_stats(spark, sf_dir):
    return rounded(bucket_stats(_events(spark, sf_dir), S, E, PARTS))


def q_bucket_stats_by_type(spark, sf_dir):
    return rounded(bucket_stats(_events(spark, sf_dir), S, E, TYPE_PARTS, device_type=TYPE_FILTER))


def q_device_type_stats(spark, sf_dir):
    return rounded(device_type_stats(_events(spark, sf_dir), S, E))


def q_recent_data(spark, sf_dir):
    return rounded(recent_data(_events(spark, sf_dir), E, 1))


def q_recent_device(spark, sf_dir):
    return rounded(recent_device(_events(spark, sf_dir), E, 7))


def q_append_recent_rows(spark, sf_dir):
    return rounded(recent_rows(recent_data(_events(spark, sf_dir), E, 1), E))


def q_group_stats(spark, sf_dir):
    return rounded(group_stats(_events(spark, sf_dir), [TENANT, TYPE], ddof=0, distinct_devices=True))


def q_usual_counts(spark, sf_dir):
    r = _events(spark, sf_dir)
    st = group_stats(r, [TYPE, DEVICE], ddof=0)
    return usual_counts(r, st, [TYPE, DEVICE], rollup=[TYPE], ddof=0)


def q_usual_rate(spark, sf_dir):
    r = _events(spark, sf_dir)
    st = group_stats(r, [TENANT], ddof=1)
    u = usual_counts(r, st, [TENANT], ddof=1)
    return rounded(usual_rate(st.select(TENANT, "data_count").join(u, TENANT, "inner")))


def q_filter_identity(spark, sf_dir):
    return filter_identity(_events(spark, sf_dir), device_type=VIEW_TYPE).select(*READING_FIELDS)


def q_filter_time_range(spark, sf_dir):
    return filter_time_range(_events(spark, sf_dir), RANGE_S, RANGE_E, closed="left").select(*READING_FIELDS)


def q_filter_recent(spark, sf_dir):
    return filter_recent(_events(spark, sf_dir), E, 2).select(*READING_FIELDS)


def q_assign_time_bucket(spark, sf_dir):
    r = filter_time_range(_events(spark, sf_dir), S, E, closed="left")
    return assign_time_bucket(r, S, E, PARTS).select(*READING_FIELDS, BUCKET)


def q_parse_device_messages(spark, sf_dir):
    return parse_device_messages(_messages(_events(spark, sf_dir))).select(*READING_FIELDS)


# Every message of a tenant with the given remainder of 7 gets a bad or odd element after its first one.
_ODD_ELEMENTS = {
    1: '{"key":"x","ts":1}',                                # a member is missing: the rest is lost
    2: '{"key":"x","value":"1.5","ts":1}',                  # a text for a number
    3: 'null',
    4: '{"key":"x","value":1e400,"ts":1}',                  # infinite, and good
    5: '{"key":"x","value":1.5,"ts":1704067200000000000}',  # nanoseconds: kept, without a timestamp
    6: '7',
}


def q_parse_device_messages_bad(spark, sf_dir):
    messages = _messages(_events(spark, sf_dir))
    odd = F.create_map(*[F.lit(x) for kv in _ODD_ELEMENTS.items() for x in kv])[(F.get_json_object("value", "$.tenantId").cast("int") % 7)]
    at = F.locate("}", F.col("value"))  # end of the first element
    value = F.concat(F.substring("value", F.lit(1), at), F.lit(","), odd, F.substring("value", at + 1, F.length("value")))
    bad = messages.withColumn("value", F.coalesce(value, F.col("value")))
    return parse_device_messages(bad).select(*READING_FIELDS, F.col("ts").isNull().alias("no_timestamp"))


def q_read_reading_lines(spark, sf_dir):
    lines = format_reading_lines(_events(spark, sf_dir))
    return parse_reading_lines(lines).select(*READING_FIELDS)


def q_read_text_file(spark, sf_dir):
    path = scratch_path(spark, "lines")
    format_reading_lines(_events(spark, sf_dir)).write.text(path)
    return read_reading_lines(spark, path).select(*READING_FIELDS)


def _write_text_layout(spark, lines: DataFrame) -> str:
    """Text folders, one a week and named by arrival: all of a week comes LATE_DAYS late.

    ``lines`` has a ``value`` and the reading's time of each row; one write makes all folders."""
    root, week = scratch_path(spark, "text-hours"), 7 * DAY_MS
    end = F.expr(f"({TIME_MS} div {week}) * {week} + {week + LATE_DAYS * DAY_MS}")
    lines.select("value", end.alias("end")).write.partitionBy("end").text(root)
    for name in small_files.names(spark, root):
        if name.startswith("end="):
            small_files.move(spark, f"{root}/{name}", f"{root}/{TEXT_DIR_PREFIX}{name[4:]}")
    return root


def q_read_text_hours(spark, sf_dir):
    """The text layout with one folder a week, named by arrival; every reading comes days late."""
    readings = _events(spark, sf_dir)
    root = _write_text_layout(spark, _lines_with_time(readings))
    return filter_time_range(read_text_hours(spark, root, RANGE_S, RANGE_E), RANGE_S, RANGE_E).select(*READING_FIELDS)


def _lines_with_time(readings: DataFrame) -> DataFrame:
    return readings.select(F.concat_ws(",", *[F.col(c).cast("string") for c in READING_FIELDS]).alias("value"), TIME_MS)


def q_convert_text(spark, sf_dir):
    """The text layout converted twice into a stored table; every reading of a tenant also has a
    line that is none. Readings by their folder's hour, and the bad lines as readings of value -1."""
    lines = _lines_with_time(_events(spark, sf_dir))
    bad = lines.where(F.col("value").startswith(f"{REPORT_TENANT},")).withColumn("value", F.concat(F.lit("x"), "value"))
    root, out = _write_text_layout(spark, lines.unionByName(bad)), scratch_path(spark, "converted")
    first = convert_text(spark, root, out, folders=2)
    if convert_text(spark, root, out) != first:
        raise RuntimeError("a second run has converted something")
    parts = F.split("line", ",")
    kept_apart = read_bad_lines(spark, out).select(
        F.substring(parts[0], 2, 9).cast("bigint").alias(TENANT), parts[1].alias(TYPE), parts[2].alias(DEVICE),
        F.lit(-1.0).alias(VALUE), parts[4].cast("bigint").alias(TIME_MS), HOUR_END)
    return read_hours(spark, out, 0, E + 400 * DAY_MS).select(*READING_FIELDS, HOUR_END).unionByName(kept_apart)


def q_read_hours_late(spark, sf_dir):
    """Readings that arrive up to LATE_DAYS days late (a few arrive before their own time)."""
    path = scratch_path(spark, "hours-late")
    late = F.expr(f"make_dt_interval(0, pmod({TIME_MS}, {LATE_DAYS * 24}) - 3)")
    r = _events(spark, sf_dir).withColumn("ingest_ts", F.col("ts").cast("timestamp") + late)
    write_hourly_readings_batch(hourly_distinct_readings(r, "ingest_ts"), path)
    return filter_time_range(read_hours(spark, path, RANGE_S, RANGE_E), RANGE_S, RANGE_E).select(*READING_FIELDS)


def _ingest_copies(spark, sf_dir):
    r = _events(spark, sf_dir).withColumn("ingest_ts", F.col("ts").cast("timestamp"))
    return r.unionByName(r)


def q_hourly_distinct_readings(spark, sf_dir):
    return hourly_distinct_readings(_ingest_copies(spark, sf_dir), "ingest_ts").select(*READING_FIELDS, HOUR_END)


def q_read_hours(spark, sf_dir):
    path = scratch_path(spark, "hours")
    write_hourly_readings_batch(hourly_distinct_readings(_ingest_copies(spark, sf_dir), "ingest_ts"), path)
    return filter_time_range(read_hours(spark, path, HOURS_S, HOURS_E), HOURS_S, HOURS_E).select(*READING_FIELDS, HOUR_END)


def _stream_messages(spark, sf_dir):
    src = scratch_path(spark, "messages")
    messages = _messages(_events(spark, sf_dir))
    messages.write.json(src)
    return message_records(message_file_stream(spark, src), "value", "ingest_ts")


def q_write_hourly_readings(spark, sf_dir):
    records = _stream_messages(spark, sf_dir)
    out, ckpt = scratch_path(spark, "hourly"), scratch_path(spark, "hourly-ckpt")
    # One batch replays the whole month: few state partitions keep its
    # 720 hour folders from filling with one small file per partition.
    q = run_ingest(records, out, ckpt, trigger={"availableNow": True}, watermark=DEFAULT_WATERMARK,
                   time_source="record", state_partitions=8)
    q.awaitTermination()
    return spark.read.parquet(out).select(*READING_FIELDS, HOUR_END)


def q_ingest_processing_time(spark, sf_dir):
    """The default ingest: processing-time hour, copies pre-combined, stateful
    dedup.  One micro-batch takes every message, so all land in one hour and
    the readings come out distinct; the hour itself is the wall clock's."""
    records = _stream_messages(spark, sf_dir)
    out, ckpt = scratch_path(spark, "hourly-pt"), scratch_path(spark, "hourly-pt-ckpt")
    run_ingest(records, out, ckpt, trigger={"availableNow": True}, state_partitions=8).awaitTermination()
    return spark.read.parquet(out).select(*READING_FIELDS)


def q_ingest_two_batches(spark, sf_dir):
    """Two micro-batches of which the second repeats all messages of the first, then compacted."""
    src, messages = scratch_path(spark, "messages"), _messages(_events(spark, sf_dir))
    out, ckpt = scratch_path(spark, "hourly-2b"), scratch_path(spark, "hourly-2b-ckpt")
    for part in (messages.where(F.xxhash64("value") % 2 == 0), messages):  # a run, and so a batch of all its files, for each
        part.write.mode("append").json(src)
        records = message_records(message_file_stream(spark, src), "value", "ingest_ts")
        # The watermark spans the table, so that no hour closes between the batches.
        run_ingest(records, out, ckpt, trigger={"availableNow": True}, watermark="60 days", time_source="record",
                   state_partitions=4).awaitTermination()
    compacted = scratch_path(spark, "hourly-2b-compact")
    compact_hours(spark, out, compacted, 0, E + 400 * DAY_MS)
    return read_hours(spark, compacted, 0, E + 400 * DAY_MS).select(*READING_FIELDS, HOUR_END)


def q_read_hours_compacted(spark, sf_dir):
    """Two micro-batches, each followed by a compaction and by one that is lost before it publishes;
    the second batch repeats the last hours of the first. Read as one snapshot."""
    src, messages, mid = scratch_path(spark, "messages"), _messages(_events(spark, sf_dir)), F.timestamp_millis(F.lit(S + 15 * DAY_MS))
    out, ckpt = scratch_path(spark, "hourly-snap"), scratch_path(spark, "hourly-snap-ckpt")
    at = F.col("ingest_ts").cast("timestamp")
    for part in (messages.where(at < mid), messages.where(at >= mid - F.expr("INTERVAL 2 HOURS"))):
        part.write.mode("append").json(src)
        records = message_records(message_file_stream(spark, src), "value", "ingest_ts")
        run_ingest(records, out, ckpt, trigger={"availableNow": True}, watermark=DEFAULT_WATERMARK, time_source="record",
                   state_partitions=4).awaitTermination()
        compact_table(spark, out, DELAY_MS)
        write_generation(live_hours(spark, out).where(F.col(VALUE) > 0), out)  # lost: never published
    if closed_hours(spark, out, DELAY_MS):
        raise RuntimeError("closed hours were left uncompacted")
    return read_hours(spark, out, 0, E + 400 * DAY_MS).select(*READING_FIELDS, HOUR_END)


def q_ingest_late_rows(spark, sf_dir):
    """The second half of the table arrives first; then all of it, of which the first half is
    late and the rest are copies. Late rows lie in a table of their own; both are read."""
    src, messages = scratch_path(spark, "messages"), _messages(_events(spark, sf_dir))
    out, late, ckpt = (scratch_path(spark, f"batches{x}") for x in ("", "-late", "-ckpt"))
    for part in (messages.where(F.col("ingest_ts").cast("timestamp") >= F.timestamp_millis(F.lit(S + 15 * DAY_MS))), messages):
        part.write.mode("append").json(src)
        records = message_records(message_file_stream(spark, src), "value", "ingest_ts")
        run_ingest_batches(records, out, ckpt, late, trigger={"availableNow": True}, time_source="record").awaitTermination()
    return read_hours(spark, out, 0, E + 400 * DAY_MS, late_path=late).select(*READING_FIELDS, HOUR_END)


def q_stream_device_messages(spark, sf_dir):
    records = _stream_messages(spark, sf_dir)
    out, ckpt = scratch_path(spark, "readings"), scratch_path(spark, "readings-ckpt")
    q = (
        parse_device_messages(records, keep=("ingest_ts",)).writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.parquet(out).select(*READING_FIELDS)


def q_bucket_report(spark, sf_dir):
    stats = bucket_stats(_events(spark, sf_dir), S, E, PARTS)
    return rounded_report(bucket_report_rows(bucket_report(stats)))


def q_device_report(spark, sf_dir):
    stats = device_type_stats(_events(spark, sf_dir), S, E)
    return rounded_report(device_report_rows(device_report(stats)))


def q_publish_report(spark, sf_dir):
    """Records of the bucket report, their value parsed back to rows."""
    stats = bucket_stats(_events(spark, sf_dir), S, E, PARTS)
    records = publish_report(bucket_report(stats), tenant_id=None, kind="data")
    return rounded_report(bucket_report_rows(records, keep=("topic", "key")))


def q_publish_device_report(spark, sf_dir):
    """Records of one tenant's device report, their value parsed back to rows."""
    stats = device_type_stats(_events(spark, sf_dir), S, E, REPORT_TENANT)
    records = publish_report(device_report(stats), tenant_id=REPORT_TENANT, kind="device")
    return rounded_report(device_report_rows(records, keep=("topic", "key")))


def q_bucket_stats_lineitem(spark, sf_dir):
    return rounded(bucket_stats(_lineitem(spark, sf_dir), LI_S, LI_E, LI_PARTS), LI_DIGITS)


def q_device_type_stats_lineitem(spark, sf_dir):
    return rounded(device_type_stats(_lineitem(spark, sf_dir), LI_S, LI_E))


def q_recent_data_lineitem(spark, sf_dir):
    return rounded(recent_data(_lineitem(spark, sf_dir), LI_E, 365), LI_DIGITS)


# The same analyses forced onto the strategy for statistics too large to
# broadcast (hot groups broadcast, cold groups shuffled), so that the path
# taken at scale passes the same oracle as the broadcast one.

def q_device_type_stats_split(spark, sf_dir):
    return rounded(device_type_stats(_events(spark, sf_dir), S, E, max_broadcast_rows=0))


def q_recent_data_split(spark, sf_dir):
    return rounded(recent_data(_events(spark, sf_dir), E, 1, max_broadcast_rows=0))


def q_bucket_stats_split(spark, sf_dir):
    return rounded(bucket_stats(_events(spark, sf_dir), S, E, PARTS, max_broadcast_rows=0))


def q_recent_device_split(spark, sf_dir):
    return rounded(recent_device(_events(spark, sf_dir), E, 7, max_broadcast_rows=0))


def q_usual_counts_hot(spark, sf_dir):
    """Few groups, each with more than 1/HOT_GROUPS of the readings: all are hot."""
    r = _events(spark, sf_dir)
    st = group_stats(r, [TYPE], ddof=0)
    return usual_counts(r, st, [TYPE], ddof=0, max_broadcast_rows=0)


def _summarised(spark, sf_dir):
    """All readings as a stored table: the hours of 20 days compacted, with summaries; the rest live."""
    path = scratch_path(spark, "summarised")
    hours = hourly_distinct_readings(_events(spark, sf_dir).withColumn("ingest_ts", F.col("ts").cast("timestamp")), "ingest_ts")
    for part in (hours.where(F.col(TIME_MS) < S + 20 * DAY_MS), hours.where(F.col(TIME_MS) >= S + 20 * DAY_MS)):
        write_hourly_readings_batch(part, path)
        if not load_snapshot(spark, path).generations:
            compact_table(spark, path)
    return SummarisedTable(spark, path)


def q_bucket_stats_summaries(spark, sf_dir):
    return rounded(bucket_stats_summarised(_summarised(spark, sf_dir), S, E, PARTS))


def q_device_type_stats_summaries(spark, sf_dir):
    return rounded(device_type_stats_summarised(_summarised(spark, sf_dir), S, E))


def q_recent_data_summaries(spark, sf_dir):
    """The trailing 15 days: summaries of compacted hours, and live ones."""
    return rounded(recent_data_summarised(_summarised(spark, sf_dir), E, 15))


def q_recent_device_summaries(spark, sf_dir):
    return rounded(recent_device_summarised(_summarised(spark, sf_dir), E, 15))


def q_recent_device_lineitem(spark, sf_dir):
    return rounded(recent_device(_lineitem(spark, sf_dir), LI_E, 365))


QUERIES = {
    "bucket_stats": q_bucket_stats,
    "bucket_stats_by_type": q_bucket_stats_by_type,
    "device_type_stats": q_device_type_stats,
    "recent_data": q_recent_data,
    "recent_device": q_recent_device,
    "append_recent_rows": q_append_recent_rows,
    "group_stats": q_group_stats,
    "usual_counts": q_usual_counts,
    "usual_rate": q_usual_rate,
    "filter_identity": q_filter_identity,
    "filter_time_range": q_filter_time_range,
    "filter_recent": q_filter_recent,
    "assign_time_bucket": q_assign_time_bucket,
    "parse_device_messages": q_parse_device_messages,
    "read_reading_lines": q_read_reading_lines,
    "hourly_distinct_readings": q_hourly_distinct_readings,
    "read_hours": q_read_hours,
    "write_hourly_readings": q_write_hourly_readings,
    "stream_device_messages": q_stream_device_messages,
    "ingest_processing_time": q_ingest_processing_time,
    "bucket_report": q_bucket_report,
    "device_report": q_device_report,
    "publish_report": q_publish_report,
    "bucket_stats_lineitem": q_bucket_stats_lineitem,
    "device_type_stats_lineitem": q_device_type_stats_lineitem,
    "recent_device_lineitem": q_recent_device_lineitem,
    "recent_data_lineitem": q_recent_data_lineitem,
    "device_type_stats_split": q_device_type_stats_split,
    "recent_data_split": q_recent_data_split,
    "recent_device_split": q_recent_device_split,
    "bucket_stats_split": q_bucket_stats_split,
    "usual_counts_hot": q_usual_counts_hot,
    "publish_device_report": q_publish_device_report,
    "parse_device_messages_bad": q_parse_device_messages_bad,
    "read_text_file": q_read_text_file,
    "read_text_hours": q_read_text_hours,
    "read_hours_late": q_read_hours_late,
    "ingest_two_batches": q_ingest_two_batches,
    "read_hours_compacted": q_read_hours_compacted,
    "ingest_late_rows": q_ingest_late_rows,
    "convert_text": q_convert_text,
    "bucket_stats_summaries": q_bucket_stats_summaries,
    "device_type_stats_summaries": q_device_type_stats_summaries,
    "recent_data_summaries": q_recent_data_summaries,
    "recent_device_summaries": q_recent_device_summaries,
}


# ---------------------------------------------------------------- oracle SQL (DuckDB)

# Readings from the tables; time is floored to the millisecond as in Spark's
# unix_millis (DuckDB's epoch_ms rounds).
EV = (
    "readings AS (SELECT user_id % 50 AS tenant_id, event_type AS device_type, "
    "CAST(user_id AS VARCHAR) AS device_id, value, epoch_us(ts) // 1000 AS time_stamp, ts FROM events)"
)
LI = (
    "readings AS (SELECT l_suppkey % 50 AS tenant_id, l_returnflag || l_linestatus AS device_type, "
    "CAST(l_partkey AS VARCHAR) AS device_id, l_extendedprice AS value, "
    "epoch_us(l_shipdate) // 1000 AS time_stamp FROM lineitem)"
)
FIVE = "tenant_id, device_type, device_id, value, time_stamp"
HOUR_END_SQL = "(epoch_us(ts) // 3600000000) * 3600000 + 3600000"
SIGMA_POP = "st.sd = 0 OR abs(r.value - st.mean) <= 3 * st.sd"
SIGMA_SAMP = "st.n = 1 OR abs(r.value - st.mean) < 3 * st.sd"


def _bucket_sql(base, s, e, gap, where="TRUE", digits=DIGITS):
    return f"""
WITH {base},
r AS (SELECT value, {s} + ((time_stamp - {s}) // {gap}) * {gap} AS bucket_start FROM readings
      WHERE time_stamp >= {s} AND time_stamp < {e} AND {where}),
st AS (SELECT bucket_start, max(value) AS mx, min(value) AS mn, avg(value) AS mean, stddev_pop(value) AS sd,
       count(*) AS n FROM r GROUP BY bucket_start),
u AS (SELECT r.bucket_start, count(*) AS u FROM r JOIN st ON r.bucket_start = st.bucket_start
      WHERE {SIGMA_POP} GROUP BY r.bucket_start)
SELECT st.bucket_start, mx AS max_value, mn AS min_value, {R('mean', digits)} AS mean_value,
       {R('sd', digits)} AS stddev_value, n AS data_count, u AS usual_data_count, u / n AS usual_data_rate
FROM st JOIN u ON st.bucket_start = u.bucket_start"""


def _device_sql(base, s, e, select_all=True, where="TRUE"):
    usual = f"count(*) FILTER (WHERE {SIGMA_POP})"
    cols = (
        f"count(DISTINCT r.device_id) AS device_count, count(*) AS data_count, {usual} AS usual_data_count, "
        f"{usual} / count(*) AS usual_data_rate"
        if select_all else f"{usual} AS usual_data_count"
    )
    time = f"WHERE time_stamp >= {s} AND time_stamp <= {e} AND {where}" if s is not None else ""
    return f"""
WITH {base},
r AS (SELECT device_type, device_id, value FROM readings {time}),
st AS (SELECT device_type, device_id, avg(value) AS mean, stddev_pop(value) AS sd FROM r GROUP BY 1, 2)
SELECT r.device_type, {cols}
FROM r JOIN st ON r.device_type = st.device_type AND r.device_id = st.device_id GROUP BY r.device_type"""


def _recent_data_sql(base, e, days, with_date=False, digits=DIGITS):
    date = f", CAST(make_timestamp({e} * 1000) AS DATE) AS date" if with_date else ""
    return f"""
WITH {base},
r AS (SELECT tenant_id, device_type, value FROM readings
      WHERE time_stamp >= {e - days * DAY_MS} AND time_stamp <= {e}),
st AS (SELECT tenant_id, device_type, max(value) AS mx, min(value) AS mn, avg(value) AS mean,
       stddev_samp(value) AS sd, count(*) AS n FROM r GROUP BY 1, 2)
SELECT st.tenant_id, st.device_type, max(mx) AS max_value, max(mn) AS min_value,
       {R('max(mean)', digits)} AS mean_value, {R('coalesce(max(sd), 0)', digits)} AS stddev_value, max(n) AS data_count,
       count(*) AS usual_data_count, count(*) / max(n) AS usual_data_rate{date}
FROM r JOIN st ON r.tenant_id = st.tenant_id AND r.device_type = st.device_type
WHERE {SIGMA_SAMP}
GROUP BY st.tenant_id, st.device_type"""


def _recent_device_sql(base, e, days):
    return f"""
WITH {base},
r AS (SELECT tenant_id, device_type, device_id, value FROM readings
      WHERE time_stamp >= {e - days * DAY_MS} AND time_stamp <= {e}),
st AS (SELECT tenant_id, device_type, count(DISTINCT device_id) AS dc, avg(value) AS mean,
       stddev_samp(value) AS sd, count(*) AS n FROM r GROUP BY 1, 2)
SELECT st.tenant_id, st.device_type, max(dc) AS device_count, max(n) AS data_count,
       count(*) AS usual_data_count, count(*) / max(n) AS usual_data_rate
FROM r JOIN st ON r.tenant_id = st.tenant_id AND r.device_type = st.device_type
WHERE {SIGMA_SAMP}
GROUP BY st.tenant_id, st.device_type"""


def _report_sql(inner, name, key_sql, pairs, record=""):
    parts = " UNION ALL ".join(
        f"SELECT {record}'success' AS status, '{metric}' AS metric, {key_sql}, CAST({col} AS DOUBLE) AS value FROM {name}"
        for metric, col in pairs
    )
    return f"WITH {name} AS ({inner}) {parts}"


_BUCKET_METRICS = [("max", "max_value"), ("min", "min_value"), ("mean", "mean_value"), ("stdev", "stddev_value"),
                   ("count", "data_count"), ("usualCount", "usual_data_count"), ("usualRate", "usual_data_rate")]
_DEVICE_METRICS = [("deviceCount", "device_count"), ("dataCount", "data_count"), ("usualDataCount", "usual_data_count"),
                   ("usualDataRate", "usual_data_rate")]


def _bucket_report_sql(record=""):
    return _report_sql(_bucket_sql(EV, S, E, GAP), "b", "CAST(bucket_start AS VARCHAR) AS bucket", _BUCKET_METRICS, record)


def _device_report_sql(where="TRUE", record=""):
    return _report_sql(_device_sql(EV, S, E, where=where), "d", "device_type", _DEVICE_METRICS, record)


DISTINCT_HOURS = f"SELECT DISTINCT {FIVE}, {HOUR_END_SQL} AS hour_end_ms FROM readings"

ORACLE = {
    "bucket_stats": _bucket_sql(EV, S, E, GAP),
    "bucket_stats_by_type": _bucket_sql(EV, S, E, TYPE_GAP, f"device_type = '{TYPE_FILTER}'"),
    "device_type_stats": _device_sql(EV, S, E),
    "recent_data": _recent_data_sql(EV, E, 1),
    "recent_device": _recent_device_sql(EV, E, 7),
    "append_recent_rows": _recent_data_sql(EV, E, 1, with_date=True),
    "group_stats": f"""WITH {EV}
SELECT tenant_id, device_type, max(value) AS max_value, min(value) AS min_value,
       {R('avg(value)')} AS mean_value, {R('stddev_pop(value)')} AS stddev_value, count(*) AS data_count,
       count(DISTINCT device_id) AS device_count
FROM readings GROUP BY tenant_id, device_type""",
    "usual_counts": _device_sql(EV, None, None, select_all=False),
    "usual_rate": f"""WITH {EV},
st AS (SELECT tenant_id, avg(value) AS mean, stddev_samp(value) AS sd, count(*) AS n FROM readings GROUP BY 1)
SELECT st.tenant_id, max(n) AS data_count, count(*) AS usual_data_count, count(*) / max(n) AS usual_data_rate
FROM readings r JOIN st ON r.tenant_id = st.tenant_id
WHERE {SIGMA_SAMP} GROUP BY st.tenant_id""",
    "filter_identity": f"WITH {EV} SELECT {FIVE} FROM readings WHERE device_type = '{VIEW_TYPE}'",
    "filter_time_range": f"""WITH {EV} SELECT {FIVE} FROM readings
WHERE time_stamp >= {RANGE_S} AND time_stamp < {RANGE_E}""",
    "filter_recent": f"""WITH {EV} SELECT {FIVE} FROM readings
WHERE time_stamp >= {E - 2 * DAY_MS} AND time_stamp <= {E}""",
    "assign_time_bucket": f"""WITH {EV} SELECT {FIVE}, {S} + ((time_stamp - {S}) // {GAP}) * {GAP} AS bucket_start
FROM readings WHERE time_stamp >= {S} AND time_stamp < {E}""",
    "parse_device_messages": f"WITH {EV} SELECT {FIVE} FROM readings",
    "read_reading_lines": f"WITH {EV} SELECT {FIVE} FROM readings",
    "hourly_distinct_readings": f"WITH {EV} {DISTINCT_HOURS}",
    "read_hours": f"""WITH {EV}, h AS ({DISTINCT_HOURS})
SELECT * FROM h WHERE time_stamp >= {HOURS_S} AND time_stamp < {HOURS_E}""",
    "read_hours_late": f"""WITH {EV}
SELECT DISTINCT {FIVE} FROM readings WHERE time_stamp >= {RANGE_S} AND time_stamp < {RANGE_E}""",
    "read_text_file": f"WITH {EV} SELECT {FIVE} FROM readings",
    "read_text_hours": f"""WITH {EV}
SELECT {FIVE} FROM readings WHERE time_stamp >= {RANGE_S} AND time_stamp < {RANGE_E}""",
    "ingest_two_batches": f"WITH {EV} {DISTINCT_HOURS}",
    "read_hours_compacted": f"WITH {EV} {DISTINCT_HOURS}",
    "ingest_late_rows": f"WITH {EV} {DISTINCT_HOURS}",
    "convert_text": f"""WITH {EV}, t AS (SELECT {FIVE}, (time_stamp // {7 * DAY_MS} + 1) * {7 * DAY_MS} + {LATE_DAYS * DAY_MS} AS hour_end_ms FROM readings)
SELECT * FROM t UNION ALL SELECT * REPLACE (CAST(-1 AS DOUBLE) AS value) FROM t WHERE tenant_id = {REPORT_TENANT}""",
    "parse_device_messages_bad": f"""WITH {EV},
m AS (SELECT {FIVE}, tenant_id % 7 AS kind, count(*) OVER w AS n,
             row_number() OVER (PARTITION BY tenant_id, device_id, time_stamp // 1000 ORDER BY device_type, value, time_stamp) AS k
      FROM readings WINDOW w AS (PARTITION BY tenant_id, device_id, time_stamp // 1000))
SELECT {FIVE}, FALSE AS no_timestamp FROM m WHERE k = 1 OR kind IN (0, 4, 5)
UNION ALL SELECT tenant_id, 'x', device_id, CASE WHEN kind = 4 THEN CAST('Infinity' AS DOUBLE) ELSE 1.5 END,
                 CASE WHEN kind = 4 THEN 1 ELSE 1704067200000000000 END, kind = 5 FROM m WHERE k = 1 AND kind IN (4, 5)""",
    "usual_counts_hot": f"""WITH {EV},
st AS (SELECT device_type, avg(value) AS mean, stddev_pop(value) AS sd FROM readings GROUP BY 1)
SELECT r.device_type, count(*) AS usual_data_count FROM readings r JOIN st ON r.device_type = st.device_type
WHERE {SIGMA_POP} GROUP BY r.device_type""",
    "write_hourly_readings": f"WITH {EV} {DISTINCT_HOURS}",
    "stream_device_messages": f"WITH {EV} SELECT {FIVE} FROM readings",
    "ingest_processing_time": f"WITH {EV} SELECT DISTINCT {FIVE} FROM readings",
    "bucket_report": _bucket_report_sql(),
    "device_report": _device_report_sql(),
    "publish_report": _bucket_report_sql("'-1_data' AS topic, 'Statistics' AS key, "),
    "publish_device_report": _device_report_sql(f"tenant_id = {REPORT_TENANT}",
                                                f"'{REPORT_TENANT}_device' AS topic, 'Statistics' AS key, "),
    "bucket_stats_lineitem": _bucket_sql(LI, LI_S, LI_E, LI_GAP, digits=LI_DIGITS),
    "device_type_stats_lineitem": _device_sql(LI, LI_S, LI_E),
    "recent_device_lineitem": _recent_device_sql(LI, LI_E, 365),
    "recent_data_lineitem": _recent_data_sql(LI, LI_E, 365, digits=LI_DIGITS),
    "device_type_stats_split": _device_sql(EV, S, E),
    "recent_data_split": _recent_data_sql(EV, E, 1),
    "recent_device_split": _recent_device_sql(EV, E, 7),
    "bucket_stats_summaries": _bucket_sql(EV, S, E, GAP),
    "device_type_stats_summaries": _device_sql(EV, S, E),
    "recent_data_summaries": _recent_data_sql(EV, E, 15),
    "recent_device_summaries": _recent_device_sql(EV, E, 15),
    "bucket_stats_split": _bucket_sql(EV, S, E, GAP),
}
