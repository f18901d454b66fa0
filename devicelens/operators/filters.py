"""Row filters and the time bucket (O7-O10).  All are narrow: no shuffle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import TS_LIMIT_MS, bucket_start, bucket_width, ts_literal
from ..schema import ANY_ID, BUCKET, DAY_MS, DEVICE, TENANT, TIME_MS, TS, TYPE


def _given(x) -> bool:
    return x is not None and str(x) != ANY_ID


def filter_identity(df: DataFrame, tenant_id=None, device_type=None, device_id=None) -> DataFrame:
    """Equality filters on tenant, device type and device; each is optional and
    ``None`` or ``"-1"`` means any (O7)."""
    cond = F.lit(True)
    if _given(device_id):
        cond = cond & (F.col(DEVICE) == F.lit(str(device_id)))
    if _given(tenant_id):
        # As text: only a number's own digits match it (not " 7 ", "007", "1_000").
        text = str(tenant_id)
        if re.fullmatch("0|-?[1-9][0-9]*", text) and -(1 << 63) <= int(text) < 1 << 63:
            cond = cond & (F.col(TENANT) == F.lit(int(text)))
        else:
            cond = F.lit(False)
    if _given(device_type):
        cond = cond & (F.col(TYPE) == F.lit(str(device_type)))
    return df.where(cond)


def filter_time_range(df: DataFrame, start_ms: int, end_ms: int, closed: str = "left") -> DataFrame:
    """Keep readings with ``start <= time_stamp < end`` (``closed="left"``) or
    ``start <= time_stamp <= end`` (``closed="both"``) (O8).

    When the frame carries the native ``ts`` column, the equivalent range on
    ``ts`` is added as well: ``time_stamp`` is ``ts`` floored to the ms, so
    ``time_stamp >= s <=> ts >= s`` and ``time_stamp <= e <=> ts < e + 1``.
    Only the ``ts`` form reaches Parquet's ``PushedFilters`` when
    ``time_stamp`` is computed from ``ts``."""
    if closed not in ("left", "both"):
        raise ValueError("closed must be 'left' or 'both'")
    s, e = int(start_ms), int(end_ms)
    t = F.col(TIME_MS)
    cond = (t >= F.lit(s)) & ((t < F.lit(e)) if closed == "left" else (t <= F.lit(e)))
    # Beyond the range of TIMESTAMP, ``ts`` is NULL: a range that reaches there
    # is decided by ``time_stamp`` alone.
    if max(abs(s), abs(e)) < TS_LIMIT_MS and TS in df.columns and isinstance(df.schema[TS].dataType, (T.TimestampType, T.TimestampNTZType)):
        upper = e if closed == "left" else e + 1
        cond = (F.col(TS) >= ts_literal(df, s)) & (F.col(TS) < ts_literal(df, upper)) & cond
    return df.where(cond)


def filter_recent(df: DataFrame, end_ms: int, days: int = 1) -> DataFrame:
    """Closed trailing range of ``days`` x 24 h ending at ``end_ms`` (O9);
    64-bit arithmetic throughout."""
    e = int(end_ms)
    return filter_time_range(df, e - int(days) * DAY_MS, e, closed="both")


def assign_time_bucket(df: DataFrame, start_ms: int, end_ms: int, part_num: int = 1) -> DataFrame:
    """Add ``bucket_start``: start of the equal-width bucket (``part_num``
    buckets over ``[start, end)``) that holds the reading (O10)."""
    gap = bucket_width(start_ms, end_ms, part_num)
    return df.withColumn(BUCKET, bucket_start(TIME_MS, start_ms, gap))
