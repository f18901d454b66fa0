"""Device messages -> readings (O1) and the message stream source (O2).

A message is one JSON text ``{"tenantId": n, "deviceId": s, "data": [{"key":
s, "value": n, "ts": n}, ...]}``.  Rules kept from the reference:

1. Not JSON, or not an object at top level: no readings.
2. ``data`` missing or not a list: no readings.
3. ``tenantId``, ``value`` and ``ts`` must be JSON numbers; ``tenantId`` and
   ``ts`` are truncated to integers (numbers beyond 64 bits become the largest
   or smallest), ``value`` is a double (``1e400`` is infinite).  Numbers are
   read as doubles, so an integer above 2**53 keeps 53 bits.
4. The first bad element ends the message; the elements before it are kept.
   A missing ``tenantId`` or ``deviceId`` therefore yields nothing.

All of it is built-in expressions.  Fast path: one typed parse of the whole
message; when every element is good, that is the answer.  Otherwise (a typed
array turns NULL as a whole on one non-object element) the element list is
read again as raw JSON texts, each element parsed on its own, and the list
sliced before the first bad one.  Only bad messages pay the second parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import ms_to_ts
from ..schema import (
    DEVICE, ELEMENT_DDL, MESSAGE_DDL, SOURCE_TOPIC, TENANT, TIME_MS, TS, TYPE, TYPED_MESSAGE_DDL, VALUE,
)

JSON_OPTIONS = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false", "mode": "PERMISSIVE"}
# The raw text of an element writes an overflowed number as "Infinity", like a
# text.  Real texts are marked before, so that only numbers look like that.
ELEMENT_OPTIONS = {**JSON_OPTIONS, "allowNonNumericNumbers": "true"}
_TEXT_NUMBER = r'("(?:value|ts)"\s*:\s*")'
_LONG = 9.223372036854775807e18  # 2**63 as a double
_LONG_MAX, _LONG_MIN = (1 << 63) - 1, -(1 << 63)


def _to_long(x: Column) -> Column:
    """Double -> bigint, truncated; beyond 64 bits the largest or smallest."""
    return F.when(x >= _LONG, F.lit(_LONG_MAX)).when(x <= -_LONG, F.lit(_LONG_MIN)).otherwise(x.cast("bigint"))


def _good_element(e: Column) -> Column:
    return e.isNotNull() & e["key"].isNotNull() & e["value"].isNotNull() & e["ts"].isNotNull()


def _slow_parse(value: Column) -> Column:
    """Element-by-element parse keeping the good prefix, as
    struct(tenantId, deviceId, data)."""
    m = F.from_json(F.regexp_replace(value, _TEXT_NUMBER, "$1text "), MESSAGE_DDL, JSON_OPTIONS)
    parsed = F.transform(m["data"], lambda e: F.from_json(e, ELEMENT_DDL, ELEMENT_OPTIONS))
    first_bad = F.array_position(F.transform(parsed, lambda e: ~_good_element(e)), True)
    prefix = F.when(first_bad == 0, parsed).otherwise(F.slice(parsed, 1, (first_bad - 1).cast("int")))
    return F.struct(m["tenantId"].alias("tenantId"), m["deviceId"].alias("deviceId"), prefix.alias("data"))


def _all_good(m: Column) -> Column:
    return (
        m["tenantId"].isNotNull() & m["deviceId"].isNotNull() & m["data"].isNotNull()
        & F.forall(m["data"], _good_element)
    )


def parse_device_messages(df: DataFrame, value_col: str = "value", keep=(), distinct: bool = False) -> DataFrame:
    """One reading per good element of each message in ``value_col`` (O1).

    Columns in ``keep`` (e.g. an ingest timestamp) are carried along;
    ``distinct`` drops copies inside one message before they become rows.  Narrow:
    no shuffle; ``explode`` of an empty list yields no row.  The typed parse
    is its own projection so that it is evaluated once per message."""
    keep = list(keep)
    x = df.select(*keep, F.col(value_col).cast("string").alias("_v"))
    x = x.select(*keep, "_v", F.from_json("_v", TYPED_MESSAGE_DDL, JSON_OPTIONS).alias("_m"))
    x = x.select(*keep, F.when(_all_good(F.col("_m")), F.col("_m")).otherwise(_slow_parse(F.col("_v"))).alias("_p"))
    tenant, device = F.col("_p.tenantId"), F.col("_p.deviceId")
    ok_head = tenant.isNotNull() & device.isNotNull()
    data = F.array_distinct("_p.data") if distinct else F.col("_p.data")
    # No filter on the parsed columns before the explode: the optimizer would
    # push it below the projections and parse every message again.  An outer
    # explode infers no filter either; its empty rows are dropped after it.
    x = x.select(*keep, tenant.alias("_tenant"), device.alias("_device"),
                 F.explode_outer(F.when(ok_head, data)).alias("_e"))
    x = x.where(F.col("_e").isNotNull())
    ms = _to_long(F.col("_e.ts"))
    return x.select(
        _to_long(F.col("_tenant")).alias(TENANT),
        F.col("_e.key").alias(TYPE),
        F.col("_device").alias(DEVICE),
        F.col("_e.value").alias(VALUE),
        ms.alias(TIME_MS),
        ms_to_ts(ms).alias(TS),
        *keep,
    )


def stream_device_messages(spark: SparkSession, bootstrap_servers: str, topic: str = SOURCE_TOPIC,
                           starting_offsets: str = "latest", options: dict | None = None) -> DataFrame:
    """Kafka subscription as a streaming frame of (``value`` text,
    ``ingest_ts``) (O2).  Offsets live in the query's checkpoint, so a restart
    resumes where it stopped.  Needs the spark-sql-kafka package on the class
    path (not bundled with PySpark)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return message_records(reader.load())


def message_records(df: DataFrame, value_col: str = "value", time_col: str = "timestamp") -> DataFrame:
    """Any (streaming or batch) frame of records -> (``value`` text,
    ``ingest_ts``): the shape the ingest pipeline takes."""
    return df.select(F.col(value_col).cast("string").alias("value"), F.col(time_col).alias("ingest_ts"))


def message_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stand-in for the topic: JSON-lines files of ``{"value": text,
    "ingest_ts": timestamp}`` dropped into ``path``."""
    reader = spark.readStream.schema("value string, ingest_ts timestamp")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(path)
