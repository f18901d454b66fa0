"""Attach per-group statistics to every reading, without collecting groups.

The 3-sigma rule needs each reading next to the mean and standard deviation
of its group, so every analysis is two passes over the readings: pass 1 is a
grouped aggregate (partial aggregation map-side, so a hot group costs one
partial row per task), pass 2 joins the readings with those statistics.  A
window partitioned by the group key would instead put a whole group into one
task.

How pass 2 joins, decided per call:

1. The statistics have a *static* bound on their row count (e.g. the number
   of time buckets) within the broadcast budget: broadcast them.  Readings are
   not shuffled at all.
2. Otherwise the statistics are materialized once (reliable checkpoint in the
   shared checkpoint folder) and measured in the same job (observed metrics):
   groups, readings and bytes (fixed row width plus the actual string
   lengths).  Within the session's ``spark.sql.autoBroadcastJoinThreshold``:
   broadcast.
3. Beyond the budget: split the groups.  Of N readings, a *hot* group has more
   than N / HOT_GROUPS, so there are fewer than HOT_GROUPS hot groups.  Readings
   of hot groups meet their broadcast statistics where they are read (no
   shuffle, however many copies a hot group holds).  The other readings are
   shuffled on the group key to meet the rest of the statistics; there, no
   group brings more than N / HOT_GROUPS readings to a task.  With hot groups
   the readings are scanned three times in all, without them twice.
   When the measurements show no hot group at all, that shuffled join is the
   whole plan (one scan of the readings).

The result has the group keys, ``value``, the statistics columns and ``_w``
(readings a row stands for, 1 here); aggregate with ``sum("_w")``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import COUNT, VALUE
from ..session import materialize

WEIGHT = "_w"
#: A group with more than 1/HOT_GROUPS of the readings is hot.
HOT_GROUPS = 1000


@dataclass
class GroupStats:
    df: DataFrame
    keys: list
    strategy: str  # "broadcast" | "split"
    groups: int | None = None  # exact row count when materialized
    rows: int | None = None  # readings behind the groups, when materialized
    bytes: int | None = None  # size of the statistics as rows, when materialized
    largest: int | None = None  # readings in the largest group, when materialized


def _fixed_width(schema: T.StructType) -> int:
    """Bytes per row of an UnsafeRow without its variable-length part: null
    bits, one 8-byte slot per field, plus 8 for the hash table's entry."""
    return 8 * (1 + (len(schema.fields) + 63) // 64) + 8 * len(schema.fields)


def _estimated_width(schema: T.StructType) -> int:
    """Conservative width of one row when string lengths are unknown."""
    return _fixed_width(schema) + sum(32 for f in schema.fields if isinstance(f.dataType, T.StringType))


def broadcast_bytes(spark) -> int:
    """The session's broadcast threshold in bytes (<= 0: never broadcast)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    raw = raw[:-1] if raw.endswith("b") else raw
    mult = units.get(raw[-1:], 1)
    try:
        return int(float(raw.rstrip("kmgt")) * mult)
    except ValueError:
        return 10 << 20


def broadcast_row_budget(stats: DataFrame) -> int:
    """Rows of ``stats`` that surely fit the broadcast threshold."""
    limit = broadcast_bytes(stats.sparkSession)
    return max(limit // _estimated_width(stats.schema), 0) if limit > 0 else 0


def plan_group_stats(stats: DataFrame, keys, *, static_groups: int | None = None,
                     max_broadcast_rows: int | None = None, count_col: str = COUNT) -> GroupStats:
    """Choose how ``stats`` (one row per group) meets the readings.

    ``max_broadcast_rows`` overrides the session's byte threshold with a row
    count (0 forces the split strategy)."""
    keys = list(keys)
    budget = broadcast_row_budget(stats) if max_broadcast_rows is None else int(max_broadcast_rows)
    if static_groups is not None and static_groups <= budget:
        return GroupStats(stats, keys, "broadcast")
    # Materialize once; the measurements (groups, readings, bytes of the
    # variable-length fields) are collected by the same job as observed
    # metrics, in its result stage, so they count each row once.
    strings = [F.coalesce(F.octet_length(f.name), F.lit(0)) + F.lit(7) for f in stats.schema.fields
               if isinstance(f.dataType, T.StringType)]
    var = F.sum(sum(((s / 8).cast("bigint") * 8 for s in strings), F.lit(0).cast("bigint")))
    has_count = count_col in stats.columns
    total = F.sum(count_col) if has_count else F.lit(None).cast("bigint")
    largest = F.max(count_col) if has_count else F.lit(None).cast("bigint")
    obs = Observation()
    stats = materialize(stats.observe(obs, F.count(F.lit(1)).alias("g"), total.alias("n"), var.alias("v"),
                                      largest.alias("x")))
    m = obs.get
    groups, rows, var_bytes = m["g"], m["n"], m["v"]
    # Spark's hash table keeps the key beside the row: count both.
    size = 2 * (groups * _fixed_width(stats.schema) + (var_bytes or 0))
    if max_broadcast_rows is None:
        fits = 0 < size <= broadcast_bytes(stats.sparkSession) or groups == 0
    else:
        fits = groups <= budget
    return GroupStats(stats, keys, "broadcast" if fits else "split", groups, rows, size, m["x"])


def attach_group_stats(rows: DataFrame, gs: GroupStats, count_col: str = COUNT) -> DataFrame:
    """Readings (``keys`` + ``value``) joined with their group's statistics."""
    keys = gs.keys
    stat_cols = [c for c in gs.df.columns if c not in keys]
    r = rows.select(*keys, VALUE)
    if gs.strategy == "broadcast":
        return r.withColumn(WEIGHT, F.lit(1).cast("bigint")).join(F.broadcast(gs.df), keys, "inner")
    return _split_join(r, gs, stat_cols, count_col)


def _split_join(r: DataFrame, gs: GroupStats, stat_cols, count_col: str) -> DataFrame:
    keys = gs.keys
    threshold = (gs.rows or 0) // HOT_GROUPS  # > threshold is hot: fewer than HOT_GROUPS such groups
    r = r.withColumn(WEIGHT, F.lit(1).cast("bigint"))
    if gs.largest is not None and gs.largest <= threshold:
        # No hot group (known from the measurements): one shuffled join, one scan.
        return r.join(gs.df.hint("shuffle_hash"), keys, "inner")
    hot = gs.df.where(F.col(count_col) > F.lit(threshold))
    cold = gs.df.where(F.col(count_col) <= F.lit(threshold))
    # Hot groups: statistics broadcast (fewer than HOT_GROUPS rows), readings stay put.
    hot_rows = r.join(F.broadcast(hot), keys, "inner")
    # Cold groups: shuffled join; no group holds more than N / HOT_GROUPS readings.  The
    # hint keeps Spark from broadcasting statistics it cannot size.
    cold_rows = r.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(
        cold.hint("shuffle_hash"), keys, "inner"
    )
    return hot_rows.unionByName(cold_rows)
