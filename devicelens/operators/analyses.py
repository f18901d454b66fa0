"""The four analyses (O14-O17), each two passes over the readings: grouped
statistics, then the readings joined with them (see plans.group_join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import bucket_width
from ..functions.usual import usual_rate
from ..plans.group_join import WEIGHT, attach_group_stats, plan_group_stats
from ..schema import (
    BUCKET, BUCKET_COLUMNS, COUNT, DEVICE, DEVICES, MAX, MEAN, MIN, RATE, STDDEV, TENANT, TYPE, USUAL,
    VALUE,
)
from .filters import assign_time_bucket, filter_identity, filter_recent, filter_time_range
from .stats import group_stats, usual_flag


def _usual_with_stats(j: DataFrame, keys, carry, ddof: int) -> DataFrame:
    """Usual count per group, carrying the group's (constant) statistics."""
    return j.where(usual_flag(ddof)).groupBy(*keys).agg(
        F.sum(WEIGHT).alias(USUAL), *[F.max(c).alias(c) for c in carry]
    )


def bucket_count(start_ms: int, end_ms: int, part_num: int) -> int:
    """Upper bound of the number of buckets: a static bound for the plan."""
    if end_ms <= start_ms:
        return 0
    gap = bucket_width(start_ms, end_ms, part_num)
    return -(-(int(end_ms) - int(start_ms)) // gap)


def bucket_stats(df: DataFrame, start_ms: int, end_ms: int, part_num: int = 1, tenant_id=None,
                 device_type=None, device_id=None, *, max_broadcast_rows: int | None = None) -> DataFrame:
    """Per time bucket over ``[start, end)``: max, min, mean, population sd,
    count, usual count (``sd = 0 or |v - mean| <= 3 sd``) and rate (O14).
    Buckets without readings are absent."""
    r = filter_identity(df, tenant_id, device_type, device_id)
    r = filter_time_range(r, start_ms, end_ms, closed="left")
    r = assign_time_bucket(r, start_ms, end_ms, part_num).select(BUCKET, VALUE)
    st = group_stats(r, [BUCKET], ddof=0)
    gs = plan_group_stats(st, [BUCKET], static_groups=bucket_count(start_ms, end_ms, part_num),
                          max_broadcast_rows=max_broadcast_rows)
    out = _usual_with_stats(attach_group_stats(r, gs), [BUCKET], [MAX, MIN, MEAN, STDDEV, COUNT], 0)
    return out.select(*BUCKET_COLUMNS[:-1], usual_rate(USUAL, COUNT).alias(RATE))


def device_type_stats(df: DataFrame, start_ms: int, end_ms: int, tenant_id=None, *,
                      max_broadcast_rows: int | None = None) -> DataFrame:
    """Per device type over ``[start, end]``: distinct devices, readings,
    readings within 3 population sigma of *their own device's* mean, and the
    rate (O15).  The same device id under two tenants is one device."""
    r = filter_identity(df, tenant_id=tenant_id)
    r = filter_time_range(r, start_ms, end_ms, closed="both").select(TYPE, DEVICE, VALUE)
    st = group_stats(r, [TYPE, DEVICE], ddof=0, extremes=False)
    gs = plan_group_stats(st, [TYPE, DEVICE], max_broadcast_rows=max_broadcast_rows)
    usual = attach_group_stats(r, gs).where(usual_flag(0)).groupBy(TYPE).agg(F.sum(WEIGHT).alias(USUAL))
    per_type = gs.df.groupBy(TYPE).agg(F.count(F.lit(1)).alias(DEVICES), F.sum(COUNT).alias(COUNT))
    # per_type has at most as many rows as the statistics: broadcast only when
    # those were measured (or bounded) within the budget.
    per_type = F.broadcast(per_type) if gs.strategy == "broadcast" else per_type.hint("shuffle_hash")
    return per_type.join(usual, TYPE, "inner").select(
        TYPE, DEVICES, COUNT, USUAL, usual_rate(USUAL, COUNT).alias(RATE)
    )


def recent_data(df: DataFrame, end_ms: int, days: int = 1, *,
                max_broadcast_rows: int | None = None) -> DataFrame:
    """Per (tenant, device type) over the trailing ``days`` x 24 h ending at
    ``end_ms`` (closed): max, min, mean, sample sd (0 for one reading),
    count, usual count (``n = 1 or |v - mean| < 3 sd``) and rate (O16).
    A group of two or more equal readings has no usual reading and is absent."""
    r = filter_recent(df, end_ms, days).select(TENANT, TYPE, VALUE)
    keys = [TENANT, TYPE]
    st = group_stats(r, keys, ddof=1)
    gs = plan_group_stats(st, keys, max_broadcast_rows=max_broadcast_rows)
    out = _usual_with_stats(attach_group_stats(r, gs), keys, [MAX, MIN, MEAN, STDDEV, COUNT], 1)
    return out.select(
        TENANT, TYPE, MAX, MIN, MEAN, F.coalesce(F.col(STDDEV), F.lit(0.0)).alias(STDDEV), COUNT, USUAL,
        usual_rate(USUAL, COUNT).alias(RATE),
    )


def recent_device(df: DataFrame, end_ms: int, days: int = 1, *,
                  max_broadcast_rows: int | None = None) -> DataFrame:
    """Per (tenant, device type) over the trailing ``days`` x 24 h: distinct
    devices, readings, usual readings (sample-sd rule of :func:`recent_data`)
    and the rate (O17)."""
    r = filter_recent(df, end_ms, days)
    keys = [TENANT, TYPE]
    st = group_stats(r.select(TENANT, TYPE, DEVICE, VALUE), keys, ddof=1, distinct_devices=True, extremes=False)
    gs = plan_group_stats(st, keys, max_broadcast_rows=max_broadcast_rows)
    out = _usual_with_stats(attach_group_stats(r.select(TENANT, TYPE, VALUE), gs), keys, [DEVICES, COUNT], 1)
    return out.select(TENANT, TYPE, DEVICES, COUNT, USUAL, usual_rate(USUAL, COUNT).alias(RATE))
