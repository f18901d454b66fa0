"""Result sinks: message queue records and JDBC rows."""

from .jdbc import append_recent, recent_rows
from .kafka import publish_report, report_topic, write_kafka

__all__ = ["append_recent", "publish_report", "recent_rows", "report_topic", "write_kafka"]
