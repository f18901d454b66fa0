"""Device telemetry analytics on PySpark.

    from devicelens import read_hours, bucket_stats, bucket_report
    readings = read_hours(spark, "s3://bucket/readings", start_ms, end_ms)
    report = bucket_report(bucket_stats(readings, start_ms, end_ms, part_num=24))

Every function takes and returns DataFrames; see README.md for the design.
"""

from .operators import (
    assign_time_bucket,
    bucket_stats,
    device_type_stats,
    filter_identity,
    filter_recent,
    filter_time_range,
    group_stats,
    recent_data,
    recent_device,
    usual_counts,
    usual_rate,
)
from .operators.dedup import hourly_distinct_readings
from .operators.report import bucket_report, device_report
from .session import build_session, cluster_conf, prepare_session
from .sinks import append_recent, publish_report, recent_rows, write_kafka
from .sources import (
    format_reading_lines,
    message_file_stream,
    message_records,
    parse_device_messages,
    parse_reading_lines,
    read_hours,
    read_reading_lines,
    read_text_hours,
    stream_device_messages,
)
from .sources.summaries import SummarisedTable
from .streaming import (
    compact_table, convert_text, print_stream, readings_stream, remove_compacted, run_ingest, run_ingest_batches,
    run_ingest_sessions, write_hourly_readings, write_hourly_readings_batch,
)

__all__ = [
    "SummarisedTable", "append_recent", "assign_time_bucket", "bucket_report", "bucket_stats", "build_session", "cluster_conf", "compact_table", "convert_text",
    "device_report", "device_type_stats", "filter_identity", "filter_recent", "filter_time_range",
    "format_reading_lines", "group_stats", "hourly_distinct_readings", "message_file_stream", "message_records",
    "parse_device_messages", "parse_reading_lines", "prepare_session", "print_stream", "publish_report",
    "read_hours", "read_reading_lines", "read_text_hours", "readings_stream", "recent_data", "recent_device",
    "recent_rows", "remove_compacted", "run_ingest", "run_ingest_batches", "run_ingest_sessions", "stream_device_messages", "usual_counts", "usual_rate", "write_hourly_readings",
    "write_hourly_readings_batch", "write_kafka",
]
