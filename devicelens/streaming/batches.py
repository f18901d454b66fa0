"""Ingest by batches: hours that never go back, and late rows kept (O2 -> O1 -> O3 -> O4).

The stateful ingest (streaming.ingest) drops what lies behind its watermark: with record
time, rows whose hour has closed; with processing time, whole batches if the driver's clock
steps back over the end of an hour. This one keeps every row. Each micro-batch first notes
what it goes by, its hour (never before the last batch's) or the time up to which hours are
closed, in ``<checkpoint>/batches/<batch id>``; a batch that runs again after a failure goes
by its note. Then its readings are taken against those stored for the same hours: what is
there already is a copy. New readings of open hours go to the table, those of closed hours
to a table of late rows.

The comparison makes a replay harmless: what the lost attempt has written is found and not
written again. It reads the five columns of the batch's hours only (day and hour folders
are named), in a join on all fields, in which no key is hot: rows are distinct.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timecols import ms_to_ts
from ..schema import BATCH_INTERVAL, DAY_MS, HOUR_END, HOUR_MS, READING_FIELDS, TIME_MS, TS
from ..sources.hours import FAR_DAYS, read_snapshot
from ..sources.messages import parse_device_messages
from ..storage import small_files
from .ingest import write_hourly_readings_batch

DELAY_MS = 300_000
NOTES = "batches"
LATE = "_late"
#: Notes kept for counts and replays (Spark replays the last batch only).
KEPT_NOTES = 300


def _note(checkpoint: str, batch: int, done: bool = False) -> str:
    return f"{checkpoint.rstrip('/')}/{NOTES}/{batch:012d}{'.done' if done else ''}"


def _batches(spark: SparkSession, checkpoint: str, done: bool = False) -> list[int]:
    names = small_files.names(spark, f"{checkpoint.rstrip('/')}/{NOTES}")
    return sorted(int(n[:12]) for n in names if n[:12].isdigit() and n.endswith(".done") == done)


def _last(spark: SparkSession, checkpoint: str, batch: int) -> dict:
    """Note of the batch before."""
    before = [b for b in _batches(spark, checkpoint) if b < batch]
    return json.loads(small_files.read_text(spark, _note(checkpoint, before[-1]))) if before else {}


def _fixed(spark: SparkSession, checkpoint: str, batch: int, note: dict) -> dict:
    """The batch's note: the one it made when it first ran, or ``note``."""
    path = _note(checkpoint, batch)
    if small_files.create_text(spark, path, json.dumps(note)):
        return note
    return json.loads(small_files.read_text(spark, path))


def stored_of_hours(spark: SparkSession, path: str, hours: list[int]) -> DataFrame:
    """The table's readings of some ingest hours, live or compacted."""
    # a reading lies under a day near its arrival, or in the folder of far-off days
    days = ((min(hours) - 1) // DAY_MS - FAR_DAYS, (max(hours) - 1) // DAY_MS + FAR_DAYS)
    return read_snapshot(spark, path, days).where(F.col(HOUR_END).isin(hours)).select(*READING_FIELDS, HOUR_END)


def batch_writer(path: str, checkpoint: str, late_path: str, time_source: str = "processing", delay_ms: int = DELAY_MS,
                 now_ms: Callable[[], int] | None = None) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: readings with ``ingest_ts`` into both tables."""
    if time_source not in ("processing", "record"):
        raise ValueError("time_source must be 'processing' or 'record'")
    clock = now_ms or (lambda: int(time.time() * 1000))
    keys = [*READING_FIELDS, HOUR_END]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        last = _last(spark, checkpoint, number)
        rows = batch.persist()  # parsed once; a lost block is parsed again
        kept = [batch]
        try:
            if time_source == "processing":
                hour = max(clock() // HOUR_MS * HOUR_MS + HOUR_MS, last.get("hour", 0))
                note = _fixed(spark, checkpoint, number, {"hour": hour})
                rows, closed = rows.withColumn(HOUR_END, F.lit(note["hour"]).cast("bigint")), None
            else:
                newest = rows.agg(F.max(F.unix_millis(F.col("ingest_ts").cast("timestamp")))).first()[0]
                newest = max(n for n in (newest, last.get("newest"), 0) if n is not None)
                # as a watermark: what earlier batches have seen, less the delay
                note = _fixed(spark, checkpoint, number, {"newest": newest, "closed": max(last.get("newest", 0) - int(delay_ms), last.get("closed", 0))})
                at = F.unix_millis(F.col("ingest_ts").cast("timestamp"))
                rows, closed = rows.withColumn(HOUR_END, (F.floor(at / F.lit(HOUR_MS)) * HOUR_MS + HOUR_MS).cast("bigint")), note["closed"]
            rows = rows.select(*keys).dropDuplicates(keys)
            hours = [r[0] for r in rows.select(HOUR_END).distinct().collect()]  # hours, not readings
            counts = {"open": 0, "late": 0}
            if hours:
                stored = stored_of_hours(spark, path, hours).unionByName(stored_of_hours(spark, late_path, hours))
                new = rows.join(stored.hint("merge"), keys, "left_anti").withColumn(TS, ms_to_ts(TIME_MS))
                late = F.lit(False) if closed is None else F.col(HOUR_END) <= closed
                new = new.withColumn(LATE, late).persist()  # compared once, counted and written from there
                kept.append(new)
                found = dict(new.groupBy(LATE).count().collect())
                for name, target, is_late in (("open", path, False), ("late", late_path, True)):
                    counts[name] = found.get(is_late, 0)
                    if counts[name]:
                        write_hourly_readings_batch(new.where(F.col(LATE) == is_late).drop(LATE), target)
            small_files.create_text(spark, _note(checkpoint, number, True), json.dumps(counts))
            for done in (False, True):
                for old in _batches(spark, checkpoint, done)[:-KEPT_NOTES]:
                    small_files.delete(spark, _note(checkpoint, old, done))
        finally:
            for df in kept:
                df.unpersist()

    return write


def run_ingest_batches(records: DataFrame, path: str, checkpoint: str, late_path: str, trigger: dict | None = None,
                       time_source: str = "processing", delay_ms: int = DELAY_MS, now_ms: Callable[[], int] | None = None) -> StreamingQuery:
    """Start the ingest on a streaming frame of (``value``, ``ingest_ts``) records.

    ``time_source="processing"``: the hour of a batch is the driver clock's, and never before
    the last batch's. ``"record"``: the hour of a record's ``ingest_ts``; a row whose hour
    ended ``delay_ms`` before the newest record of earlier batches goes to ``late_path``. Every
    distinct (hour, reading) is stored once in one of the two tables; records without
    ``ingest_ts`` have no hour and, with record time, are refused. ``read_hours(path, ...,
    late_path=...)`` reads both."""
    if time_source == "record":
        ok = F.when(F.col("ingest_ts").isNotNull(), True).otherwise(F.raise_error(F.lit("record without ingest_ts")))
        records = records.where(ok)
    readings = parse_device_messages(records, "value", keep=("ingest_ts",), distinct=True)
    writer = readings.writeStream.foreachBatch(batch_writer(path, checkpoint, late_path, time_source, delay_ms, now_ms))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": BATCH_INTERVAL})).start()


def late_counts(spark: SparkSession, checkpoint: str) -> dict[int, dict]:
    """Rows written by batch id: {"open": n, "late": m}, of the batches whose notes are kept.

    A batch that was lost after its writes counts what its second run wrote."""
    return {b: json.loads(small_files.read_text(spark, _note(checkpoint, b, True))) for b in _batches(spark, checkpoint, True)}
