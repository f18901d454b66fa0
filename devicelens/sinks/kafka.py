"""Report delivery to a message queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ANY_ID, DATA_TOPIC_SUFFIX, DEVICE_TOPIC_SUFFIX, REPORT_KEY

_SUFFIX = {"data": DATA_TOPIC_SUFFIX, "device": DEVICE_TOPIC_SUFFIX}


def report_topic(tenant_id, kind: str) -> str:
    """``<tenant>_data`` / ``<tenant>_device``; ``-1`` when no tenant is set."""
    tenant = ANY_ID if tenant_id is None else str(tenant_id)
    return tenant + _SUFFIX[kind]


def publish_report(report: DataFrame, tenant_id=None, kind: str = "data") -> DataFrame:
    """Report rows as Kafka records: ``topic``, ``key`` = "Statistics",
    ``value`` = the report text (O20)."""
    return report.select(
        F.lit(report_topic(tenant_id, kind)).alias("topic"), F.lit(REPORT_KEY).alias("key"), F.col("value")
    )


def write_kafka(records: DataFrame, bootstrap_servers: str, options: dict | None = None) -> None:
    """Send (topic, key, value) rows from the executors with Spark's Kafka
    sink.  Needs the spark-sql-kafka package on the class path."""
    w = records.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()
