"""Stored readings, partitioned by event day and ingest hour.

One table holds live files, as a stream or a batch writer left them, and compacted hours
(storage.manifest). :func:`read_hours` reads both as one snapshot: the newest manifest when
the plan is made tells for every hour where it lies."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DAY_MS, DEVICE, EVENT_DAY, HOUR_END, STORED_READINGS, TIME_MS
from ..storage.manifest import COMPACTED, GENERATION, Snapshot, load_snapshot
from .paths import range_alternatives

STORED_SCHEMA = T.StructType(STORED_READINGS.fields + [T.StructField(EVENT_DAY, T.LongType()), T.StructField(HOUR_END, T.LongType())])

#: Event day of readings whose clock is further from their ingest hour than
#: FAR_DAYS (or before 1970): one folder that every read includes.
FAR_DAY = -1
FAR_DAYS = 30
#: Writer options of stored readings: a Bloom filter of device ids in every row group, sized
#: by what it holds (128 KB at most, some 100,000 devices), for the look-up of one device.
#: Parquet itself leaves it out where a dictionary tells as much.
DEVICE_LOOKUP = {
    f"parquet.bloom.filter.enabled#{DEVICE}": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.max.bytes": str(128 << 10),
}
#: Folder in which a streaming query commits the files of its batches.
COMMIT_LOG = "_spark_metadata"


def event_day(time_ms: str = TIME_MS, hour_end: str = HOUR_END) -> Column:
    """Partition value of a reading: days since 1970 of its own time, FAR_DAY if far off.

    So a device with a broken clock cannot make folders without end, and an
    honest but late reading still lies under the day that queries ask for."""
    day = F.floor(F.col(time_ms) / F.lit(float(DAY_MS))).cast("bigint")
    arrived = F.floor((F.col(hour_end) - 1) / F.lit(float(DAY_MS))).cast("bigint")
    return F.when((day >= 0) & (F.abs(day - arrived) <= FAR_DAYS), day).otherwise(F.lit(FAR_DAY)).cast("bigint")


def day_bounds(start_ms: int, end_ms: int) -> tuple[int, int]:
    """Closed range of event days that hold ``[start, end]``."""
    return int(start_ms) // DAY_MS, int(end_ms) // DAY_MS


def day_partition_filter(start_ms: int, end_ms: int) -> Column:
    lo, hi = day_bounds(start_ms, end_ms)
    return F.col(EVENT_DAY).between(F.lit(lo), F.lit(hi)) | (F.col(EVENT_DAY) == FAR_DAY)


def has_commit_log(spark: SparkSession, path: str) -> bool:
    """Was the table at ``path`` written by a streaming query?"""
    jvm = spark.sparkContext._jvm
    log = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/" + COMMIT_LOG)
    return log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log)


def _existing(reader, *paths: str) -> DataFrame | None:
    """The files of the paths, or None if there are none."""
    try:
        return reader.parquet(*paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return None


def live_hours(spark: SparkSession, path: str, days: tuple[int, int] | None = None) -> DataFrame | None:
    """The table's live files, of the event ``days`` (first, last) and FAR_DAY; None if there are none.

    A table that a stream writes is read through the stream's commit log, so files of a
    batch that never committed are not seen and no folder is listed; ``days`` is left to
    the partition filter. Otherwise the day folders are named in one glob whose alternatives
    are the decimal prefixes covering exactly the days, so that only those are listed."""
    reader = spark.read.schema(STORED_SCHEMA)
    if has_commit_log(spark, path):
        return _existing(reader, path)
    root, names = path.rstrip("/"), "*" if days is None else "{" + ",".join([*range_alternatives(*days), str(FAR_DAY)]) + "}"
    return _existing(reader.option("basePath", path), f"{root}/{EVENT_DAY}={names}")


def compacted_hours(spark: SparkSession, path: str, snapshot: Snapshot, days: tuple[int, int] | None = None) -> DataFrame | None:
    """The snapshot's compacted hours, of the event ``days`` and FAR_DAY. The manifest names the
    folders that there are, so only those of the days are listed."""
    base = f"{path.rstrip('/')}/{COMPACTED}"
    wanted = [(g, d) for g in snapshot.generations for d in g.days if days is None or d == FAR_DAY or days[0] <= d <= days[1]]
    if not wanted:
        return None
    schema = T.StructType([*STORED_SCHEMA.fields, T.StructField(GENERATION, T.StringType())])
    rows = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{GENERATION}={g.id}/{EVENT_DAY}={d}" for g, d in wanted])
    for g in {g.id: g for g, _ in wanted if g.superseded}.values():
        rows = rows.where(~((F.col(GENERATION) == g.id) & F.col(HOUR_END).isin(g.superseded)))
    return rows.drop(GENERATION)


def read_snapshot(spark: SparkSession, path: str, days: tuple[int, int] | None = None, snapshot: Snapshot | None = None) -> DataFrame:
    """Live and compacted hours of a table as one frame (STORED_SCHEMA), each hour from one place."""
    snapshot = load_snapshot(spark, path) if snapshot is None else snapshot
    live, done = live_hours(spark, path, days), compacted_hours(spark, path, snapshot, days)
    if live is not None and (hours := list(snapshot.owners())):
        live = live.where(~F.col(HOUR_END).isin(hours))  # a set of partition values: whole folders are left out
    found = [df.select(*STORED_SCHEMA.names) for df in (live, done) if df is not None]
    if not found:
        return spark.createDataFrame([], STORED_SCHEMA)
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def read_hours(spark: SparkSession, path: str, start_ms: int, end_ms: int, late_path: str | None = None) -> DataFrame:
    """Every stored reading that can lie in ``[start, end]``, however late it
    arrived; only its event days (and FAR_DAY) are read (O6).

    Compacted and live hours are read as one snapshot (:func:`read_snapshot`). ``late_path``
    is the table of late rows that an ingest keeps apart (streaming.batches). The partition
    predicate is in the plan either way (``PartitionFilters``); the exact time filter is
    the analysis' own."""
    days = day_bounds(start_ms, end_ms)
    rows = read_snapshot(spark, path, days)
    if late_path:
        rows = rows.unionByName(read_snapshot(spark, late_path, days))
    return rows.where(day_partition_filter(start_ms, end_ms))
