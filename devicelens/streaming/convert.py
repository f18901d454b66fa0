"""The reference's text layout into the stored table, repeatably (O5 -> O4).

The text holds one folder ``device-data-<ms>`` an hourly window. Folders are converted in
groups; each group becomes a generation of the table (storage.manifest), whose manifest
entry is the ledger: the hour of every converted folder, with a fingerprint of its files.
A run converts what the ledger does not have or has otherwise, and replaces those hours as
a whole. So it can be run again, after a failure, after more text has come, or for nothing.

A line that is no reading ends nothing: it goes, with its hour, to a table of bad lines
beside the generation, and is read by :func:`read_bad_lines`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import EVENT_DAY, HOUR_END, READING_FIELDS, TS
from ..sources.hours import event_day, live_hours
from ..sources.lines import TEXT_DIR_PREFIX, parse_reading_lines
from ..storage import small_files
from ..storage.manifest import BAD_LINES, GENERATION, Snapshot, load_snapshot, publish
from .compaction import file_hours, write_generation

#: Folders converted together: two weeks of hours.
FOLDERS = 336


def text_folders(spark: SparkSession, root: str) -> dict[int, str]:
    """Folder of every hour of the text layout."""
    names = small_files.names(spark, root)
    hours = {int(n[len(TEXT_DIR_PREFIX):]): n for n in names if n.startswith(TEXT_DIR_PREFIX) and n[len(TEXT_DIR_PREFIX):].isdigit()}
    return {h: f"{root.rstrip('/')}/{n}" for h, n in sorted(hours.items())}


def convert_text(spark: SparkSession, root: str, path: str, folders: int = FOLDERS) -> Snapshot:
    """Bring the table at ``path`` up to the text at ``root``; returns the snapshot in force.

    Refuses hours that the table has as live files: they came from elsewhere, and a
    generation would hide them."""
    found, snapshot = text_folders(spark, root), load_snapshot(spark, path)
    live = live_hours(spark, path)
    if live is not None and (both := (file_hours(live.inputFiles()) - set(snapshot.owners())) & set(found)):
        raise ValueError(f"{path} has live files of hours that the text has, too: {sorted(both)[:5]}")
    done = {int(h): f for g in snapshot.generations for h, f in g.sources.items()}
    prints = {h: small_files.fingerprint(spark, f) for h, f in found.items()}
    todo = [h for h in found if done.get(h) != prints[h]]
    for k in range(0, len(todo), folders):
        hours = todo[k:k + folders]
        lines = spark.read.text([found[h] for h in hours]).select("value", F.col("_metadata.file_path").alias("_file"))
        lines = lines.withColumn(HOUR_END, F.regexp_extract("_file", rf"/{TEXT_DIR_PREFIX}([0-9]+)/", 1).cast("bigint"))
        readings, bad = parse_reading_lines(lines, "value", mode="PERMISSIVE", keep=(HOUR_END,))
        rows = readings.select(*READING_FIELDS, TS, HOUR_END).withColumn(EVENT_DAY, event_day())
        generation = write_generation(rows, path)
        bad.write.parquet(f"{path.rstrip('/')}/{BAD_LINES}/{GENERATION}={generation.id}")
        generation.hours, generation.sources = hours, {str(h): prints[h] for h in hours}
        snapshot = publish(spark, path, snapshot, generation)
    return snapshot


def read_bad_lines(spark: SparkSession, path: str, snapshot: Snapshot | None = None) -> DataFrame:
    """(``line``, ``hour_end_ms``) of the lines of converted text that are no readings."""
    snapshot = load_snapshot(spark, path) if snapshot is None else snapshot
    base, schema = f"{path.rstrip('/')}/{BAD_LINES}", f"line string, {HOUR_END} bigint, {GENERATION} string"
    names = set(small_files.names(spark, base))
    held = [g for g in snapshot.generations if f"{GENERATION}={g.id}" in names]
    if not held:
        return spark.createDataFrame([], schema).drop(GENERATION)
    rows = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{GENERATION}={g.id}" for g in held])
    for g in held:
        if g.superseded:
            rows = rows.where(~((F.col(GENERATION) == g.id) & F.col(HOUR_END).isin(g.superseded)))
    return rows.drop(GENERATION)
