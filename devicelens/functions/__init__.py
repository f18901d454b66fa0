"""Column-level helpers (all built-in Spark SQL expressions)."""

from .timecols import bucket_start, bucket_width, hour_end_ms, ms_to_ts, ts_literal, ts_to_ms
from .usual import is_usual, usual_rate

__all__ = [
    "bucket_start",
    "bucket_width",
    "hour_end_ms",
    "ms_to_ts",
    "ts_literal",
    "ts_to_ms",
    "is_usual",
    "usual_rate",
]
