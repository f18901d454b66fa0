"""Mergeable hourly moments (O11), and the analyses from them.

A summary row stands for the readings of one device, type and tenant in one hour of their
own time: count, mean, sum of squared distances from that mean, least and largest value.
Rows of any number of hours merge to the statistics of a group by the rule for pooled
variances, so pass 1 of an analysis reads summaries in place of readings.

Pass 2 counts the readings within three standard deviations of their group. Where a
row's least and largest value both lie inside the band, all its readings do; where both lie
beyond it on one side, none does. Readings are read for the other rows only, from the day
and hour folders that hold them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import bucket_start, bucket_width
from ..functions.usual import is_usual, usual_rate
from ..plans.group_join import GroupStats, attach_group_stats, plan_group_stats
from ..schema import (
    BUCKET, BUCKET_COLUMNS, COUNT, DEVICE, DEVICES, EVENT_DAY, HOUR_END, HOUR_MS, MAX, MEAN, MIN, RATE, STDDEV, TENANT,
    TIME_MS, TYPE, USUAL, VALUE,
)
from .filters import filter_identity

EVENT_HOUR = "event_hour"
N, CENTRE, SQUARES, LEAST, LARGEST = "n", "mean", "squares", "least", "largest"
MOMENTS = [N, CENTRE, SQUARES, LEAST, LARGEST]
GROUP = [TENANT, TYPE, DEVICE]
#: Where a row's readings lie, when they are, whose they are, and their moments.
SUMMARY_DDL = (f"{EVENT_DAY} bigint, {HOUR_END} bigint, {EVENT_HOUR} bigint, {TENANT} bigint, {TYPE} string, {DEVICE} string, "
               f"{N} bigint, {CENTRE} double, {SQUARES} double, {LEAST} double, {LARGEST} double")
PLACE = [EVENT_DAY, HOUR_END]


def event_hour(time_ms: str = TIME_MS) -> Column:
    """Start (epoch ms) of the clock hour of a reading's own time."""
    return F.expr(f"`{time_ms}` - pmod(`{time_ms}`, {HOUR_MS})")


def hourly_summary(readings: DataFrame) -> DataFrame:
    """Stored readings (with their day and hour folder) to summary rows: one grouped aggregate.

    Equal readings have their value as mean and no squares, whatever the order of summation."""
    x = readings.groupBy(*PLACE, event_hour().alias(EVENT_HOUR), *GROUP).agg(
        F.count(F.lit(1)).alias(N), F.avg(VALUE).alias("_mean"), F.var_pop(VALUE).alias("_var"), F.min(VALUE).alias(LEAST), F.max(VALUE).alias(LARGEST))
    equal = F.col(LEAST) == F.col(LARGEST)
    return x.select(*PLACE, EVENT_HOUR, *GROUP, N, F.when(equal, F.col(LEAST)).otherwise(F.col("_mean")).alias(CENTRE),
                    F.when(equal, 0.0).otherwise(F.col("_var") * F.col(N)).alias(SQUARES), LEAST, LARGEST)


def merged_stats(summary: DataFrame, keys, ddof: int = 0, distinct_devices: bool = False, *, static_groups: int | None = None,
                 max_broadcast_rows: int | None = None) -> DataFrame:
    """Group statistics from summary rows, with the columns of ``group_stats``.

    Squares around a group's mean are those of its rows, and their distances from that mean:
    ``sum(squares + n * (mean - group mean)^2)``. The group means meet the rows as statistics
    meet readings (plans.group_join): no group is gathered, a hot one is not shuffled."""
    keys = list(keys)
    total = F.sum(N)
    centre = [total.alias(COUNT), F.min(LEAST).alias(MIN), F.max(LARGEST).alias(MAX), (F.sum(F.col(N) * F.col(CENTRE)) / total).alias("_centre")]
    if distinct_devices:
        centre.append(F.countDistinct(DEVICE).alias(DEVICES))
    means = summary.groupBy(*keys).agg(*centre)
    means = means.withColumn("_centre", F.when(F.col(MIN) == F.col(MAX), F.col(MIN)).otherwise(F.col("_centre")))
    gs = plan_group_stats(means, keys, static_groups=static_groups, max_broadcast_rows=max_broadcast_rows)
    rows = attach_group_stats(summary.select(*keys, F.struct(N, CENTRE, SQUARES).alias(VALUE)), gs)
    part = F.col(f"{VALUE}.{SQUARES}") + F.col(f"{VALUE}.{N}") * F.pow(F.col(f"{VALUE}.{CENTRE}") - F.col("_centre"), F.lit(2.0))
    carried = [COUNT, MIN, MAX, "_centre", *([DEVICES] if distinct_devices else [])]
    out = rows.groupBy(*keys).agg(F.sum(part).alias("_squares"), *[F.max(c).alias(c) for c in carried])
    squares = F.when(F.col(MIN) == F.col(MAX), 0.0).otherwise(F.col("_squares"))
    freedom = F.col(COUNT) - ddof
    sd = F.when(freedom > 0, F.sqrt(squares / freedom))
    return out.select(*keys, MAX, MIN, F.col("_centre").alias(MEAN), sd.alias(STDDEV), COUNT, *([DEVICES] if distinct_devices else []))


def usual_from_summaries(summary: DataFrame, readings: Callable[[list[int], list[int]], DataFrame], gs: GroupStats, ddof: int,
                         keys_of: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Usual readings per group (``gs.keys``), ``USUAL``; groups without one are absent.

    ``readings(days, hours)`` gives the readings of some event days and ingest hours, and
    ``keys_of(frame, time column)`` adds the group keys to summary rows or readings. The driver
    gets the days and hours that must be read, numbers that go with the hours of the range."""
    keys, place = gs.keys, [*PLACE, EVENT_HOUR, *GROUP]
    rows = keys_of(summary, EVENT_HOUR)
    rows = attach_group_stats(rows.select(*keys, F.struct(*place, N, LEAST, LARGEST).alias(VALUE)), gs)
    low, high = F.col(f"{VALUE}.{LEAST}"), F.col(f"{VALUE}.{LARGEST}")
    inside = is_usual(low, MEAN, STDDEV, COUNT, ddof) & is_usual(high, MEAN, STDDEV, COUNT, ddof)
    neither = ~is_usual(low, MEAN, STDDEV, COUNT, ddof) & ~is_usual(high, MEAN, STDDEV, COUNT, ddof)
    beyond = neither & ((high < F.col(MEAN)) | (low > F.col(MEAN)) | (F.col(STDDEV) == 0.0))
    whole = rows.where(inside).groupBy(*keys).agg(F.sum(f"{VALUE}.{N}").alias(USUAL))
    # NaN compares as the largest value: a row that has one is neither inside nor beyond
    open_ = rows.where(~F.coalesce(inside, F.lit(False)) & ~F.coalesce(beyond, F.lit(False))).select(f"{VALUE}.*").select(*place)
    where = open_.select(*PLACE).distinct().collect()
    if not where:
        return whole
    days, hours = (sorted({r[c] for r in where}) for c in PLACE)
    r = readings(days, hours).withColumn(EVENT_HOUR, event_hour())
    r = r.join(open_.hint("shuffle_hash"), place, "left_semi")
    r = attach_group_stats(keys_of(r, TIME_MS), gs)
    rest = r.where(is_usual(VALUE, MEAN, STDDEV, COUNT, ddof)).groupBy(*keys).agg(F.count(F.lit(1)).alias(USUAL))
    return whole.unionByName(rest).groupBy(*keys).agg(F.sum(USUAL).alias(USUAL))


def _analysis(table, start_ms: int, end_ms: int, closed: str, keys, ddof: int, keys_of, distinct_devices: bool = False, static_groups: int | None = None,
              identity: tuple = (), max_broadcast_rows: int | None = None) -> DataFrame:
    """Statistics of the groups with their usual counts, as one row a group."""
    summary = filter_identity(table.summary(start_ms, end_ms, closed), *identity)
    stats = merged_stats(keys_of(summary, EVENT_HOUR), keys, ddof, distinct_devices, static_groups=static_groups, max_broadcast_rows=max_broadcast_rows)
    gs = plan_group_stats(stats, keys, max_broadcast_rows=max_broadcast_rows)

    def readings(days, hours):
        return filter_identity(table.readings(start_ms, end_ms, closed, days, hours), *identity)

    usual = usual_from_summaries(summary, readings, gs, ddof, keys_of)
    # as many rows as there are groups, which were measured for gs
    usual = F.broadcast(usual) if gs.strategy == "broadcast" else usual.hint("shuffle_hash")
    return gs.df.join(usual, list(keys), "inner")


def bucket_stats_summarised(table, start_ms: int, end_ms: int, part_num: int = 1, tenant_id=None, device_type=None, device_id=None, *,
                            max_broadcast_rows: int | None = None) -> DataFrame:
    """``bucket_stats`` (O14) from summaries; start and bucket width must be whole hours."""
    gap = bucket_width(start_ms, end_ms, part_num)
    if start_ms % HOUR_MS or gap % HOUR_MS:
        raise ValueError("buckets must begin and end with clock hours; use bucket_stats")

    def keys_of(df, time_col):
        return df.withColumn(BUCKET, bucket_start(time_col, start_ms, gap))

    out = _analysis(table, start_ms, end_ms, "left", [BUCKET], 0, keys_of, static_groups=part_num if part_num > 0 else 1,
                    identity=(tenant_id, device_type, device_id), max_broadcast_rows=max_broadcast_rows)
    return out.select(*BUCKET_COLUMNS[:-1], usual_rate(USUAL, COUNT).alias(RATE))


def _same(df: DataFrame, time_col: str) -> DataFrame:
    return df


def recent_data_summarised(table, end_ms: int, days: int = 1, *, max_broadcast_rows: int | None = None) -> DataFrame:
    """``recent_data`` (O16) from summaries."""
    start = int(end_ms) - int(days) * 24 * HOUR_MS
    out = _analysis(table, start, int(end_ms), "both", [TENANT, TYPE], 1, _same, max_broadcast_rows=max_broadcast_rows)
    return out.select(TENANT, TYPE, MAX, MIN, MEAN, F.coalesce(F.col(STDDEV), F.lit(0.0)).alias(STDDEV), COUNT, USUAL, usual_rate(USUAL, COUNT).alias(RATE))


def recent_device_summarised(table, end_ms: int, days: int = 1, *, max_broadcast_rows: int | None = None) -> DataFrame:
    """``recent_device`` (O17) from summaries: a device is counted from its rows, not its readings."""
    start = int(end_ms) - int(days) * 24 * HOUR_MS
    out = _analysis(table, start, int(end_ms), "both", [TENANT, TYPE], 1, _same, distinct_devices=True, max_broadcast_rows=max_broadcast_rows)
    return out.select(TENANT, TYPE, DEVICES, COUNT, USUAL, usual_rate(USUAL, COUNT).alias(RATE))


def device_type_stats_summarised(table, start_ms: int, end_ms: int, tenant_id=None, *, max_broadcast_rows: int | None = None) -> DataFrame:
    """``device_type_stats`` (O15) from summaries."""
    out = _analysis(table, start_ms, end_ms, "both", [TYPE, DEVICE], 0, _same, identity=(tenant_id,), max_broadcast_rows=max_broadcast_rows)
    usual = out.groupBy(TYPE).agg(F.count(F.lit(1)).alias(DEVICES), F.sum(COUNT).alias(COUNT), F.sum(USUAL).alias(USUAL))
    return usual.select(TYPE, DEVICES, COUNT, USUAL, usual_rate(USUAL, COUNT).alias(RATE))
