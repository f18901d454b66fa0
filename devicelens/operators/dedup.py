"""Hourly duplicate removal (O3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import ms_to_ts
from ..schema import HOUR_END, READING_FIELDS, TIME_MS, TS

WINDOW = "_hour"


def hourly_distinct_readings(df: DataFrame, ingest_col: str = "ingest_ts",
                             watermark: str | None = None) -> DataFrame:
    """Exact duplicates removed within each 1-hour tumbling window of ingest
    time; ``hour_end_ms`` (epoch ms of the window end) is added (O3).

    The same function serves batch and streaming.  For a stream pass a
    ``watermark`` delay: the window is part of the dedup key, so a window's
    state is dropped once the watermark passes its end, and a row that
    arrives later than the watermark is dropped.  In batch the dedup is a
    grouped aggregate: copies collapse map-side before the shuffle."""
    x = df.withWatermark(ingest_col, watermark) if watermark else df
    # Only the key reaches the shuffle (and, in a stream, the state store).
    x = x.select(F.window(F.col(ingest_col), "1 hour").alias(WINDOW), *READING_FIELDS)
    x = x.dropDuplicates([WINDOW, *READING_FIELDS])
    end_ms = F.unix_millis(F.col(f"{WINDOW}.end").cast("timestamp"))
    return x.select(*READING_FIELDS, ms_to_ts(TIME_MS).alias(TS), end_ms.alias(HOUR_END))
