"""Readings derived from the driver's tables (see FIXTURES.md).

``events``: tenant = user_id % 50, device type = event_type, device id =
user_id as text, value = value, time = ts.  ``lineitem`` (larger bench
input): tenant = l_suppkey % 50, type = returnflag || linestatus, device =
l_partkey as text, value = l_extendedprice, time = l_shipdate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.timecols import ts_to_ms
from .schema import DEVICE, TENANT, TIME_MS, TS, TYPE, VALUE

TENANTS = 50

# Fixed parameters of the registered queries (FIXTURES.md).
START_MS = 1704067200000  # 2024-01-01T00:00:00Z
END_MS = 1706659200000  # 2024-01-31T00:00:00Z
PARTS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        (F.col("user_id") % F.lit(TENANTS)).alias(TENANT),
        F.col("event_type").alias(TYPE),
        F.col("user_id").cast("string").alias(DEVICE),
        F.col("value").alias(VALUE),
        ts_to_ms("ts").alias(TIME_MS),
        F.col("ts").alias(TS),
    )


def readings_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        (F.col("l_suppkey") % F.lit(TENANTS)).alias(TENANT),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias(TYPE),
        F.col("l_partkey").cast("string").alias(DEVICE),
        F.col("l_extendedprice").alias(VALUE),
        ts_to_ms("l_shipdate").alias(TIME_MS),
        F.col("l_shipdate").alias(TS),
    )


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(table(spark, sf_dir, "events"))


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_lineitem(table(spark, sf_dir, "lineitem"))
