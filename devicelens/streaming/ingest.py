"""Streaming ingest: messages -> readings -> hourly de-duplicated Parquet
(O2 -> O1 -> O3 -> O4), one Structured Streaming query with a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import hourly_distinct_readings
from ..schema import BATCH_INTERVAL, DEVICE, EVENT_DAY, HOUR_END, HOUR_MS, READING_FIELDS, TENANT, TYPE
from ..sources.hours import DEVICE_LOOKUP, event_day, has_commit_log, live_hours, read_hours
from ..sources.messages import parse_device_messages
from ..storage.manifest import load_snapshot
from .compaction import file_hours, compact_table, log_retention, remove_compacted

DEFAULT_WATERMARK = "5 minutes"
# State partitions of the dedup (fixed at a query's first start and kept in its
# checkpoint).  Size them to one micro-batch, not to the batch analyses: each
# partition writes its own file per hour per batch.
DEFAULT_STATE_PARTITIONS = 32
#: Rows of one micro-batch that a state partition is meant for.
ROWS_PER_STATE_PARTITION = 500_000


def state_partitions_for(rows_per_batch: int, slots: int) -> int:
    """State partitions for a new checkpoint: one per ROWS_PER_STATE_PARTITION rows that
    a micro-batch is expected to bring (readings per second x trigger interval, at the
    busiest), at least one, and in whole waves of the cluster's ``slots`` beyond one wave.
    Also the number of files that a batch adds to an hour, until it is compacted."""
    n = max(1, -(-int(rows_per_batch) // ROWS_PER_STATE_PARTITION))
    return n if n <= slots else -(-n // slots) * slots


_PRE_KEY = "_pre_hour"


def _batch_distinct(keys: list):
    """Arrow batches -> the same rows without copies inside each batch (the
    earliest ingest time kept), in C++ (pyarrow ``group_by``).  A closure
    over plain values, so it reaches the Python workers by value and needs
    no import of this package there."""
    keys = list(keys)

    def distinct(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows == 0:
                continue
            g = pa.Table.from_batches([b]).group_by(keys).aggregate([("ingest_ts", "min")])
            names = ["ingest_ts" if c == "ingest_ts_min" else c for c in g.column_names]
            yield from g.rename_columns(names).select([*keys, "ingest_ts"]).to_batches()

    return distinct


def precombine_copies(readings: DataFrame) -> DataFrame:
    """Collapse copies of a reading (same fields, same ingest hour) within
    each Arrow batch of each task, before the stateful dedup shuffles them.

    A streaming ``dropDuplicates`` has no map-side combine: every copy goes
    to the state partition of its key, so a device that floods one reading
    would load one task with all its copies.  No built-in streaming operator
    pre-combines, hence this Arrow step; the stateful dedup still makes the
    result exact across batches and tasks."""
    x = readings.select(*READING_FIELDS, "ingest_ts",
                        F.floor(F.unix_millis(F.col("ingest_ts").cast("timestamp")) / F.lit(HOUR_MS))
                        .cast("bigint").alias(_PRE_KEY))
    out = x.select(*READING_FIELDS, _PRE_KEY, "ingest_ts")
    return out.mapInArrow(_batch_distinct([*READING_FIELDS, _PRE_KEY]), out.schema).drop(_PRE_KEY)


def readings_stream(records: DataFrame, watermark: str = DEFAULT_WATERMARK,
                    time_source: str = "processing", precombine: bool = False, floor_ms: int | None = None) -> DataFrame:
    """(``value``, ``ingest_ts``) records -> de-duplicated readings with
    ``hour_end_ms``.

    ``time_source="processing"`` (default, the reference's semantics): the
    hour is the one in which the micro-batch runs.  Spark fixes a batch's
    ``current_timestamp()`` in its offset log, so a batch replayed after a
    failure lands in the same hour.  Every row of a batch is at the watermark,
    so none is late, unless the driver's clock steps back over the end of an
    hour: ``floor_ms`` (the newest stored hour, see :func:`run_ingest`) covers
    a restart on a host whose clock is behind; streaming.batches covers steps
    while a query runs, too.

    ``time_source="record"``: the hour of the record's ``ingest_ts`` (the
    Kafka record timestamp), replayable from the topic alone.  Records more
    than ``watermark`` behind the newest one seen, whose hour has closed,
    are dropped.

    Copies inside one message are dropped before they become rows.
    ``precombine`` also collapses copies across the messages of a task before
    the shuffle, in Python workers (see :func:`precombine_copies`): for devices
    that flood one reading in many messages."""
    if time_source == "processing":
        now = F.current_timestamp()
        records = records.withColumn("ingest_ts", now if floor_ms is None else F.greatest(now, F.timestamp_millis(F.lit(int(floor_ms)))))
        watermark = "0 seconds"
    elif time_source != "record":
        raise ValueError("time_source must be 'processing' or 'record'")
    readings = parse_device_messages(records, "value", keep=("ingest_ts",), distinct=True)
    if precombine:
        readings = precombine_copies(readings)
    return hourly_distinct_readings(readings, "ingest_ts", watermark=watermark)


def write_hourly_readings(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                          query_name: str | None = None, state_partitions: int = DEFAULT_STATE_PARTITIONS,
                          retention: str | None = None) -> StreamingQuery:
    """Append readings to Parquet partitioned by ``event_day`` and ``hour_end_ms``.

    ``trigger`` defaults to the reference's 5-minute batches; tests pass
    ``{"availableNow": True}``.  The checkpoint keeps source offsets and the
    dedup state, so a restarted query resumes without loss or repeats.
    ``state_partitions`` applies only to a new checkpoint; the query takes
    the session's settings when it starts, so it is set just for ``start``.
    ``retention`` lets older entries leave the sink's commit log; take it from
    compaction.log_retention, under which only compacted hours go."""
    w = (
        df.withColumn(EVENT_DAY, event_day()).writeStream.format("parquet").options(**DEVICE_LOOKUP)
        .outputMode("append")
        .partitionBy(EVENT_DAY, HOUR_END)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        w = w.queryName(query_name)
    if retention:
        w = w.option("retention", retention)
    w = w.trigger(**(trigger or {"processingTime": BATCH_INTERVAL}))
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    if before == str(int(state_partitions)):
        return w.start()
    # The query copies the session's settings when it starts.  Other queries
    # started on this session in the same instant would see the value too;
    # start streams from one thread, or give them a session of their own.
    conf.set("spark.sql.shuffle.partitions", str(int(state_partitions)))
    try:
        return w.start()
    finally:
        conf.set("spark.sql.shuffle.partitions", before)


def write_hourly_readings_batch(df: DataFrame, path: str, mode: str = "append") -> None:
    """Batch form of O4: append a de-duplicated frame to the same layout.

    Refuses a path that a stream writes: readers go by the stream's commit log
    and would not see the files.

    The ``rebalance`` hint lets AQE send each hour to few tasks (splitting a
    large hour into advisory-size pieces, merging small ones), so an hour is
    a handful of files instead of one per task.  Within a task, rows are
    sorted by hour, tenant, type and device: the writer needs the hour order
    anyway, and clustered identity columns let Parquet's row-group statistics
    skip most of an hour for a tenant/type/device filter."""
    if has_commit_log(df.sparkSession, path):
        raise ValueError(f"{path} is written by a stream; append to a table of its own")
    days = df.withColumn(EVENT_DAY, event_day())
    clustered = days.hint("rebalance", EVENT_DAY, HOUR_END).sortWithinPartitions(EVENT_DAY, HOUR_END, TENANT, TYPE, DEVICE)
    (clustered.write.mode(mode).options(**DEVICE_LOOKUP).option("partitionOverwriteMode", "dynamic")
     .partitionBy(EVENT_DAY, HOUR_END).parquet(path))


def compact_hours(spark: SparkSession, source: str, target: str, from_hour_end: int, to_hour_end: int) -> None:
    """Copy the closed ingest hours ``from <= hour_end_ms < to`` of a streamed table to the
    table ``target``, a few files a folder, clustered like any batch.

    Each (event day, hour) folder of ``target`` is replaced as a whole, so a run that was
    lost half-way is simply run again.  Read ``target`` for compacted hours, ``source``
    for later ones; files under the stream's log are never touched."""
    hours = read_hours(spark, source, 0, (1 << 62)).where(F.col(HOUR_END).between(int(from_hour_end), int(to_hour_end) - 1))
    write_hourly_readings_batch(hours.drop(EVENT_DAY), target, mode="overwrite")


def newest_hour(spark: SparkSession, path: str) -> int | None:
    """Newest ingest hour of a stored table, live or compacted (its ``hour_end_ms``)."""
    live = live_hours(spark, path)
    hours = file_hours(live.inputFiles()) if live is not None else set()
    return max([*hours, *load_snapshot(spark, path).owners()], default=None)


def run_ingest(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
               watermark: str = DEFAULT_WATERMARK, state_partitions: int = DEFAULT_STATE_PARTITIONS,
               time_source: str = "processing", precombine: bool = False, retention: str | None = None) -> StreamingQuery:
    """Start the whole ingest query on a streaming frame of records.

    With processing time, no batch gets an hour before the newest one stored, whatever
    this host's clock says."""
    floor = newest_hour(records.sparkSession, path) if time_source == "processing" else None
    readings = readings_stream(records, watermark, time_source, precombine, None if floor is None else floor - 1)
    return write_hourly_readings(readings, path, checkpoint, trigger, state_partitions=state_partitions, retention=retention)


def rows_dropped(query: StreamingQuery) -> int:
    """Rows behind the watermark that the query's recent batches dropped (record time only)."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p["stateOperators"])


def run_ingest_sessions(records: DataFrame, path: str, checkpoint: str, session_ms: int, delay_ms: int = 0,
                        sessions: int | None = None, **options) -> None:
    """:func:`run_ingest` in sessions of ``session_ms`` (``sessions`` of them, or without end).

    Between two sessions closed hours are compacted, what no reader names any more is
    deleted, and the next one gets the log retention that this allows. So neither the log
    nor the live files grow with the table's age. Stopping a query is safe at any time: a
    batch that was under way is run again. A query that ends by itself ends the sessions."""
    spark = records.sparkSession
    while sessions is None or sessions > 0:
        query = run_ingest(records, path, checkpoint, retention=log_retention(spark, path, session_ms), **options)
        ended = query.awaitTermination(session_ms / 1000)
        if not ended:
            query.stop()
        compact_table(spark, path, delay_ms)
        remove_compacted(spark, path)
        if ended:
            return
        sessions = None if sessions is None else sessions - 1


def print_stream(df: DataFrame, trigger: dict | None = None, num_rows: int = 20) -> StreamingQuery:
    """Debug view of a stream (the reference printed every record): Spark's
    console sink, which prints each micro-batch on the driver.  For
    debugging only; it is not part of the ingest query."""
    w = df.writeStream.format("console").option("truncate", "false").option("numRows", str(num_rows))
    return w.trigger(**(trigger or {"processingTime": BATCH_INTERVAL})).start()
