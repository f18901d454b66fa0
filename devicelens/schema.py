"""Schemas and column names of the readings table and the result tables.

A *reading* is one measurement of one device:

    tenant_id   bigint   owner of the device
    device_type string   the metric / device type (the message field ``key``)
    device_id   string
    value       double
    time_stamp  bigint   epoch milliseconds
    ts          timestamp (optional) the same instant as a native timestamp

Invariants:

- when ``ts`` is present, ``time_stamp`` is ``ts`` floored to the
  millisecond (``ts`` is NULL where TIMESTAMP cannot hold the number).  Time filters use ``time_stamp`` for the exact rule and add an
  implied predicate on ``ts`` so that Parquet can skip row groups;
- ``tenant_id``, ``device_type`` and ``device_id`` are never NULL (every reader
  here drops or rejects such rows).  The analyses join readings to their
  group's statistics on these keys with plain equality.
"""

from __future__ import annotations

from pyspark.sql import types as T

TENANT = "tenant_id"
TYPE = "device_type"
DEVICE = "device_id"
VALUE = "value"
TIME_MS = "time_stamp"
TS = "ts"
HOUR_END = "hour_end_ms"
EVENT_DAY = "event_day"
BUCKET = "bucket_start"

READING_FIELDS = [TENANT, TYPE, DEVICE, VALUE, TIME_MS]

READINGS = T.StructType(
    [
        T.StructField(TENANT, T.LongType()),
        T.StructField(TYPE, T.StringType()),
        T.StructField(DEVICE, T.StringType()),
        T.StructField(VALUE, T.DoubleType()),
        T.StructField(TIME_MS, T.LongType()),
    ]
)

# Stored readings: the five fields plus the native timestamp; partitioned by
# EVENT_DAY (days since 1970 of the reading's own time, see sources.hours) and
# HOUR_END (epoch ms of the end of the ingest hour).
STORED_READINGS = T.StructType(READINGS.fields + [T.StructField(TS, T.TimestampType())])

# Device message as sent by devices (one JSON text per record).  The element
# list is first read as raw JSON texts so that each element can be validated
# on its own (see sources.messages).
MESSAGE_DDL = "tenantId double, deviceId string, data array<string>"
ELEMENT_DDL = "key string, value double, ts double"
TYPED_MESSAGE_DDL = f"tenantId double, deviceId string, data array<struct<{ELEMENT_DDL}>>"

# Result columns.
MAX = "max_value"
MIN = "min_value"
MEAN = "mean_value"
STDDEV = "stddev_value"
COUNT = "data_count"
DEVICES = "device_count"
USUAL = "usual_data_count"
RATE = "usual_data_rate"
DATE = "date"

RECENT_DATA_COLUMNS = [TENANT, TYPE, MAX, MIN, MEAN, STDDEV, COUNT, USUAL, RATE]
RECENT_DEVICE_COLUMNS = [TENANT, TYPE, DEVICES, COUNT, USUAL, RATE]
BUCKET_COLUMNS = [BUCKET, MAX, MIN, MEAN, STDDEV, COUNT, USUAL, RATE]
DEVICE_TYPE_COLUMNS = [TYPE, DEVICES, COUNT, USUAL, RATE]

# Fixed values that must equal the reference's for right results.
HOUR_MS = 3_600_000
DAY_MS = 86_400_000
SIGMAS = 3
REPORT_KEY = "Statistics"
NO_DATA_STATUS = "No Matching Data"
OK_STATUS = "success"
DATA_TOPIC_SUFFIX = "_data"
DEVICE_TOPIC_SUFFIX = "_device"
ANY_ID = "-1"  # an identity argument of "-1" means "any"
SOURCE_TOPIC = "deviceData"
BATCH_INTERVAL = "300 seconds"
