"""One device's readings: row groups without it are not read."""

import glob

import pytest
from pyspark.sql import functions as F

from devicelens.operators import filter_identity
from devicelens.schema import HOUR_END
from devicelens.sources import read_hours
from devicelens.sources import hours as module
from devicelens.streaming import compaction, ingest, write_hourly_readings_batch

H = 3_600_000
PLAIN = {"parquet.enable.dictionary": "false", "parquet.block.size": str(64 << 10), "parquet.page.size": "4096",
         "parquet.block.size.row.check.min": "100", "parquet.page.size.row.check.min": "100"}


def scanned(df):
    """Rows that the scans of a plan hand on, which is whole row groups."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def table(spark, path):
    from devicelens.functions.timecols import ms_to_ts

    # as a stream leaves them: devices in no order, every file has ids from all over the range
    r = spark.range(40_000, numPartitions=1).select(
        F.lit(1).cast("bigint").alias("tenant_id"), F.lit("t").alias("device_type"), F.sha2(F.col("id").cast("string"), 256).alias("device_id"),
        F.col("id").cast("double").alias("value"), (F.col("id") % 1000).alias("time_stamp"))
    r = r.withColumn("ts", ms_to_ts("time_stamp")).withColumn(HOUR_END, F.lit(H).cast("bigint"))
    r.withColumn(module.EVENT_DAY, F.lit(0).cast("bigint")).write.options(**ingest.DEVICE_LOOKUP).partitionBy(module.EVENT_DAY, HOUR_END).parquet(path)
    return r


def test_row_groups_without_the_device_are_skipped(spark, tmpdir_path, monkeypatch):
    read = {}
    for name, bloom in (("before", False), ("after", True)):
        monkeypatch.setattr(ingest, "DEVICE_LOOKUP", {**(module.DEVICE_LOOKUP if bloom else {}), **PLAIN})
        r = table(spark, f"{tmpdir_path}/{name}")
        wanted = r.where("value = 12345").first().device_id
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            df = filter_identity(read_hours(spark, f"{tmpdir_path}/{name}", 0, H), device_id=wanted)
            read[name] = scanned(df)
            assert [x.value for x in df.collect()] == [12345.0]
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
    assert 0 < read["after"] <= 0.25 * read["before"], read


@pytest.mark.parametrize("writer", ["batch", "stream", "generation"])
def test_all_writers_take_the_options(spark, readings, tmpdir_path, writer, monkeypatch):
    for m in (ingest, compaction):
        monkeypatch.setattr(m, "DEVICE_LOOKUP", {**module.DEVICE_LOOKUP, **PLAIN})
    rows = readings([(1, "t", f"device-{k}", float(k), k) for k in range(50)]).withColumn(HOUR_END, F.lit(H).cast("bigint"))
    path = f"{tmpdir_path}/t"
    if writer == "stream":
        rows.write.parquet(f"{tmpdir_path}/in")
        df = spark.readStream.schema(rows.schema).parquet(f"{tmpdir_path}/in")
        ingest.write_hourly_readings(df, path, f"{tmpdir_path}/c", trigger={"availableNow": True}).awaitTermination()
    elif writer == "batch":
        write_hourly_readings_batch(rows, path)
    else:
        compaction.write_generation(rows.withColumn(module.EVENT_DAY, module.event_day()), path)
    files = [f for f in glob.glob(f"{path}/**/*.parquet", recursive=True) if "_summaries" not in f]
    # a Bloom filter's header lies behind the row groups: the file is longer than one without
    assert files and all(_bloom(f) for f in files)


def _bloom(path):
    import pyarrow.parquet as pq

    meta = pq.ParquetFile(path).metadata
    ends = [c.data_page_offset + c.total_compressed_size for g in range(meta.num_row_groups) for i in range(meta.num_columns) if (c := meta.row_group(g).column(i))]
    import os

    footer = meta.serialized_size
    return os.path.getsize(path) - footer - max(ends) > 64
