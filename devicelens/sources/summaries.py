"""Stored summaries beside compacted hours, and the table that the analyses read them through."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import filter_time_range
from ..operators.summaries import EVENT_HOUR, SUMMARY_DDL, hourly_summary
from ..schema import EVENT_DAY, HOUR_END, HOUR_MS
from ..storage import small_files
from ..storage.manifest import GENERATION, SUMMARIES, Snapshot, load_snapshot
from .hours import compacted_hours, day_bounds, live_hours, read_snapshot


def write_summary(spark: SparkSession, path: str, generation) -> None:
    """Summarise a written generation, in a folder of its own, clustered by hour."""
    rows = compacted_hours(spark, path, Snapshot(0, [generation]))
    if rows is not None:
        summary = hourly_summary(rows).hint("rebalance", HOUR_END).sortWithinPartitions(HOUR_END, EVENT_HOUR)
        summary.write.parquet(f"{path.rstrip('/')}/{SUMMARIES}/{GENERATION}={generation.id}")


def stored_summaries(spark: SparkSession, path: str, snapshot: Snapshot, days: tuple[int, int]) -> DataFrame | None:
    """Summary rows of the snapshot's compacted hours; a generation without any is summarised now."""
    base = f"{path.rstrip('/')}/{SUMMARIES}"
    names = set(small_files.names(spark, base))
    have = [g for g in snapshot.generations if f"{GENERATION}={g.id}" in names]
    parts = []
    if have:
        rows = spark.read.schema(f"{SUMMARY_DDL}, {GENERATION} string").option("basePath", base).parquet(*[f"{base}/{GENERATION}={g.id}" for g in have])
        for g in have:
            if g.superseded:
                rows = rows.where(~((F.col(GENERATION) == g.id) & F.col(HOUR_END).isin(g.superseded)))
        parts.append(rows.drop(GENERATION))
    rest = [g for g in snapshot.generations if f"{GENERATION}={g.id}" not in names]
    if rest and (rows := compacted_hours(spark, path, Snapshot(snapshot.version, rest), days)) is not None:
        parts.append(hourly_summary(rows))
    return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


class SummarisedTable:
    """A stored table (and its late rows) as one snapshot: readings and summaries of a range."""

    def __init__(self, spark: SparkSession, path: str, late_path: str | None = None):
        self.spark = spark
        self.tables = [(p, load_snapshot(spark, p)) for p in (path, late_path) if p]

    def readings(self, start_ms: int, end_ms: int, closed: str, days=None, hours=None) -> DataFrame:
        """Readings of the range, of some event days and ingest hours if given (whole folders are left out)."""
        bounds = day_bounds(start_ms, end_ms) if days is None else (min(days), max(days))
        out = functools.reduce(DataFrame.unionByName, [read_snapshot(self.spark, p, bounds, snapshot) for p, snapshot in self.tables])
        if days is not None:
            out = out.where(F.col(EVENT_DAY).isin(days) & F.col(HOUR_END).isin(hours))
        return filter_time_range(out, start_ms, end_ms, closed)

    def summary(self, start_ms: int, end_ms: int, closed: str = "left") -> DataFrame:
        """Summary rows of exactly the readings of the range.

        Whole hours come from stored summaries where their ingest hours were compacted; the live
        ones, and the readings of a first or last hour that the range cuts, are summarised now."""
        limit = int(end_ms) + (1 if closed == "both" else 0)
        first, last = -(-int(start_ms) // HOUR_MS) * HOUR_MS, limit // HOUR_MS * HOUR_MS
        days, parts = day_bounds(start_ms, end_ms), []
        for path, snapshot in self.tables:
            hours = list(snapshot.owners())
            live = live_hours(self.spark, path, days)
            if live is not None:
                live = live.where(~F.col(HOUR_END).isin(hours)) if hours else live
                parts.append(hourly_summary(filter_time_range(live, start_ms, limit, "left")))
            stored = stored_summaries(self.spark, path, snapshot, days)
            if stored is not None:
                parts.append(stored.where((F.col(EVENT_HOUR) >= first) & (F.col(EVENT_HOUR) < last)))
            cut = [(a, b) for a, b in ((int(start_ms), min(first, limit)), (max(last, first), limit)) if a < b]
            if first > last:  # the range lies inside one hour
                cut = [(int(start_ms), limit)]
            for a, b in cut:
                done = compacted_hours(self.spark, path, snapshot, day_bounds(a, b - 1))
                if done is not None:
                    parts.append(hourly_summary(filter_time_range(done, a, b, "left")))
        return functools.reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], SUMMARY_DDL)
