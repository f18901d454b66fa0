"""Compaction of closed hours into generations, and what may be deleted after it.

    snapshot = compact_table(spark, path, delay_ms)   # read_hours sees old or new, nothing between
    remove_compacted(spark, path, keep_ms)            # files that no reader can name any more

A streamed table's commit log lists every file ever written until the sink's retention
lets entries go. :func:`log_retention` gives a retention under which only entries of
compacted hours can go, so the log stays as short as what is not compacted yet.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DEVICE, EVENT_DAY, HOUR_END, HOUR_MS, TENANT, TYPE
from ..sources.hours import DEVICE_LOOKUP, compacted_hours, has_commit_log, live_hours
from ..sources.summaries import write_summary
from ..storage import small_files
from ..storage.manifest import BAD_LINES, COMPACTED, GENERATION, SUMMARIES, Generation, Snapshot, load_snapshot, publish

_HOUR = re.compile(rf"/{HOUR_END}=(-?\d+)/")
#: Time of grace before files that newer plans do not name are deleted.
KEEP_MS = 24 * HOUR_MS


def file_hours(files: list[str]) -> set[int]:
    return {int(m[1]) for f in files if (m := _HOUR.search(f))}


def closed_hours(spark: SparkSession, path: str, delay_ms: int = 0) -> list[int]:
    """Live hours that can get no more rows and are not compacted yet.

    The newest hour shows how far the ingest time has come: an hour is closed when it ended
    ``delay_ms`` (the watermark's delay; 0 for processing time) before the newest hour began."""
    live = live_hours(spark, path)
    hours = file_hours(live.inputFiles()) if live is not None else set()
    done = load_snapshot(spark, path).owners()
    newest = max([*hours, *done], default=0)
    return sorted(h for h in hours if h not in done and h <= newest - HOUR_MS - int(delay_ms))


def write_generation(rows: DataFrame, path: str) -> Generation:
    """Write ``rows`` (stored readings of whole hours) and their summary as a generation that no
    manifest names yet.

    A few files a folder: the ``rebalance`` hint splits a large hour into pieces of the
    advisory size and merges small ones; rows are clustered by tenant, type and device."""
    spark, ident = rows.sparkSession, f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path.rstrip('/')}/{COMPACTED}/{GENERATION}={ident}"
    clustered = rows.hint("rebalance", EVENT_DAY, HOUR_END).sortWithinPartitions(EVENT_DAY, HOUR_END, TENANT, TYPE, DEVICE)
    clustered.write.options(**DEVICE_LOOKUP).partitionBy(EVENT_DAY, HOUR_END).parquet(folder)
    days = [int(n.split("=")[1]) for n in small_files.names(spark, folder) if n.startswith(f"{EVENT_DAY}=")]
    generation = Generation(ident, [], days)
    write_summary(spark, path, generation)
    return generation


def compact_table(spark: SparkSession, path: str, delay_ms: int = 0) -> Snapshot:
    """Copy the closed hours of ``path`` into a generation and put it into force.

    Live files are not touched. A run that is lost before its last step leaves files that
    nobody sees and is simply run again."""
    snapshot, hours = load_snapshot(spark, path), closed_hours(spark, path, delay_ms)
    if not hours:
        return snapshot
    generation = write_generation(live_hours(spark, path).where(F.col(HOUR_END).isin(hours)), path)
    generation.hours = hours
    return publish(spark, path, snapshot, generation)


def merge_generations(spark: SparkSession, path: str, before_hour: int) -> Snapshot:
    """Write the generations whose hours all end before ``before_hour`` once more, as one: fewer
    folders to list and a shorter manifest. Converted ones (streaming.convert) stay as they are."""
    snapshot = load_snapshot(spark, path)
    old = [g for g in snapshot.generations if max(g.hours) < before_hour and not g.sources]
    if len(old) < 2:
        return snapshot
    merged = write_generation(compacted_hours(spark, path, Snapshot(snapshot.version, old)), path)
    merged.hours = [h for g in old for h in g.hours]
    return publish(spark, path, snapshot, merged)


def log_retention(spark: SparkSession, path: str, session_ms: int, now_ms: int | None = None) -> str:
    """Retention of the file sink's log for a query that is stopped after ``session_ms``.

    Entries leave the log by the age of their files. The oldest file of an hour that is not
    compacted may be that old now, and ``session_ms`` older when the query is stopped and
    asks again; younger entries stay. So none goes before its hour was compacted, however
    long no compaction runs."""
    now = int(time.time() * 1000) if now_ms is None else int(now_ms)
    done, live = list(load_snapshot(spark, path).owners()), live_hours(spark, path)
    oldest = None
    if live is not None:
        # partition values and file facts only: no column is read
        open_ = live.where(~F.col(HOUR_END).isin(done)) if done else live
        oldest = open_.agg(F.min(F.unix_millis("_metadata.file_modification_time"))).first()[0]
    return f"{max(0, now - (now if oldest is None else oldest)) + int(session_ms)}ms"


def remove_compacted(spark: SparkSession, path: str, keep_ms: int = KEEP_MS, now_ms: int | None = None) -> dict[str, list]:
    """Delete what newer plans do not name: live folders of hours compacted ``keep_ms`` ago or
    earlier whose entries have left the stream's log, and generations of that age that no
    manifest names (lost half-way, or taken over). Returns what was deleted.

    Folders are deleted one by one on the driver, a number that goes with the hours compacted
    since the last run."""
    now, root = int(time.time() * 1000) if now_ms is None else int(now_ms), path.rstrip("/")
    snapshot = load_snapshot(spark, path)
    in_force = {g.id for g in snapshot.generations}
    generations = set()
    for kind in (COMPACTED, SUMMARIES, BAD_LINES):
        for name in small_files.names(spark, f"{root}/{kind}"):
            ident, folder = name.removeprefix(f"{GENERATION}="), f"{root}/{kind}/{name}"
            if ident != name and ident not in in_force and small_files.modified_ms(spark, folder) <= now - keep_ms:
                small_files.delete(spark, folder)
                generations.add(ident)
    old = {h for h, g in snapshot.owners().items() if g.published_ms <= now - keep_ms}
    if has_commit_log(spark, path) and (live := live_hours(spark, path)) is not None:
        old -= file_hours(live.inputFiles())
    hours = set()
    for day in (n for n in small_files.names(spark, root) if n.startswith(f"{EVENT_DAY}=")):
        for name in small_files.names(spark, f"{root}/{day}"):
            if name.startswith(f"{HOUR_END}=") and int(name.split("=")[1]) in old:
                small_files.delete(spark, f"{root}/{day}/{name}")
                hours.add(int(name.split("=")[1]))
    return {"hours": sorted(hours), "generations": sorted(generations)}
