"""Grouped statistics, the usual count and the usual rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.usual import is_usual, usual_rate as _usual_rate
from ..plans.group_join import WEIGHT, attach_group_stats, plan_group_stats
from ..schema import COUNT, DEVICE, DEVICES, MAX, MEAN, MIN, RATE, STDDEV, USUAL, VALUE


def group_stats(df: DataFrame, keys, ddof: int = 0, distinct_devices: bool = False,
                extremes: bool = True) -> DataFrame:
    """Per group: max and min (unless ``extremes=False``), mean, standard
    deviation (population for ``ddof=0``, sample for ``ddof=1``), reading
    count and, on request, the number of distinct devices (O11).  One grouped
    aggregate: Spark combines partial aggregates map-side, so only one row per
    group and task is shuffled however large a group is."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    aggs = [F.max(VALUE).alias(MAX), F.min(VALUE).alias(MIN)] if extremes else []
    aggs += [
        F.avg(VALUE).alias(MEAN),
        sd(VALUE).alias(STDDEV),
        F.count(F.lit(1)).alias(COUNT),
    ]
    if distinct_devices:
        aggs.append(F.countDistinct(DEVICE).alias(DEVICES))
    return df.groupBy(*keys).agg(*aggs)


def usual_flag(ddof: int):
    return is_usual(VALUE, MEAN, STDDEV, COUNT, ddof)


def usual_counts(df: DataFrame, stats: DataFrame, keys, rollup=None, ddof: int = 0, *,
                 static_groups: int | None = None, max_broadcast_rows: int | None = None) -> DataFrame:
    """Number of readings within 3 sigma of their group.

    ``stats`` comes from :func:`group_stats` on ``keys``; counts are reported
    per ``rollup`` (default: ``keys``), which must be a subset of ``keys``.
    Groups without a usual reading are absent, as with an inner join."""
    keys = list(keys)
    rollup = keys if rollup is None else list(rollup)
    gs = plan_group_stats(stats, keys, static_groups=static_groups, max_broadcast_rows=max_broadcast_rows)
    j = attach_group_stats(df, gs)
    return j.where(usual_flag(ddof)).groupBy(*rollup).agg(F.sum(WEIGHT).alias(USUAL))


def usual_rate(df: DataFrame, usual_col: str = USUAL, count_col: str = COUNT) -> DataFrame:
    """Add ``usual_data_rate`` = usual / count as a double."""
    return df.withColumn(RATE, _usual_rate(usual_col, count_col))
