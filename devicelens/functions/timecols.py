"""Column expressions on epoch-millisecond time."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import HOUR_MS, TS


#: Largest |epoch ms| that a TIMESTAMP (64-bit microseconds) holds.
TS_LIMIT_MS = (1 << 63) // 1000 - 1


def ms_to_ts(ms: Column | str) -> Column:
    """Epoch ms -> TIMESTAMP (an instant; independent of the session zone).

    NULL for a number beyond what a TIMESTAMP holds (a device that sends
    nanoseconds, say): the reading keeps its ``time_stamp``."""
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.when(c.between(-TS_LIMIT_MS, TS_LIMIT_MS), F.timestamp_millis(c))


def ts_to_ms(ts: Column | str) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ -> epoch ms, floored to the millisecond.
    A TIMESTAMP_NTZ is read in the session zone (pinned to UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(c.cast("timestamp"))


def ts_literal(df: DataFrame, ms: int, col: str = TS) -> Column:
    """A literal instant of epoch ms ``ms`` typed like ``df[col]``, so that a
    comparison with it is pushed to the Parquet scan."""
    lit = F.timestamp_millis(F.lit(int(ms)))
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return lit.cast("timestamp_ntz")
    return lit


def hour_end_ms(ms: Column | str) -> Column:
    """End (exclusive, epoch ms) of the clock hour that holds ``ms``."""
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.floor(c / F.lit(HOUR_MS)).cast("bigint") * F.lit(HOUR_MS) + F.lit(HOUR_MS)


def bucket_width(start_ms: int, end_ms: int, part_num: int) -> int:
    """Width of one of ``part_num`` equal buckets over ``[start, end)``.

    Same rounding as the reference: ceil of the double quotient; a part count
    <= 0 means 1; the width is at least 1 ms (an empty range has no rows, so
    the width only has to be a valid divisor)."""
    n = part_num if part_num > 0 else 1
    gap = math.ceil(float(end_ms - start_ms) / float(n))
    return max(int(gap), 1)


def bucket_start(ms_col: str, start_ms: int, gap: int) -> Column:
    """Start of the bucket of width ``gap`` (counted from ``start_ms``) that
    holds the epoch-ms column ``ms_col``: ``t - pmod(t - start, gap)``, exact
    64-bit arithmetic, a true floor also for readings before ``start``."""
    s, g = int(start_ms), int(gap)
    return F.expr(f"`{ms_col}` - pmod(`{ms_col}` - {s}, {g})")
