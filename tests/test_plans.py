"""Join strategies give the same answer; plans keep the intended shape."""

import pytest

from devicelens import fixtures as fx
from devicelens.operators import bucket_stats, device_type_stats, recent_data, recent_device
from devicelens.plans import group_join, plan_group_stats
from devicelens.operators.stats import group_stats
from devicelens.sources import read_hours
from devicelens.streaming import write_hourly_readings_batch
from devicelens.operators.dedup import hourly_distinct_readings

from conftest import SF_SMALL


def rows(df):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """Event readings plus one hot group holding a third of all rows, most of
    them exact copies (the skew case the split strategy is for)."""
    from pyspark.sql import functions as F

    r = fx.event_readings(spark, SF_SMALL)
    n = r.count()
    hot = r.limit(1).select(
        F.lit(7).cast("bigint").alias("tenant_id"), F.lit("click").alias("device_type"),
        F.lit("hot").alias("device_id"), "value", "time_stamp", "ts",
    )
    spread = spark.range(n // 2).select(
        F.lit(7).cast("bigint").alias("tenant_id"), F.lit("click").alias("device_type"),
        F.lit("hot").alias("device_id"), (F.col("id") % 7).cast("double").alias("value"),
        F.lit(fx.END_MS - 1000).alias("time_stamp"), F.timestamp_millis(F.lit(fx.END_MS - 1000)).alias("ts"),
    )
    return r.unionByName(hot).unionByName(spread)


@pytest.mark.parametrize("fn", ["device_type_stats", "recent_data", "recent_device", "bucket_stats"])
def test_split_equals_broadcast(skewed, fn):
    run = {
        "device_type_stats": lambda df, m: device_type_stats(df, fx.START_MS, fx.END_MS, max_broadcast_rows=m),
        "recent_data": lambda df, m: recent_data(df, fx.END_MS, 3, max_broadcast_rows=m),
        "recent_device": lambda df, m: recent_device(df, fx.END_MS, 3, max_broadcast_rows=m),
        "bucket_stats": lambda df, m: bucket_stats(df, fx.START_MS, fx.END_MS, 10, max_broadcast_rows=m),
    }[fn]
    assert rows(run(skewed, 0)) == rows(run(skewed, None))


def test_strategy_choice(spark):
    r = fx.event_readings(spark, SF_SMALL)
    st = group_stats(r, ["device_type", "device_id"])
    assert plan_group_stats(st, ["device_type", "device_id"]).strategy == "broadcast"
    gs = plan_group_stats(st, ["device_type", "device_id"], max_broadcast_rows=10)
    assert gs.strategy == "split" and gs.groups == st.count()
    # a static bound within the budget needs no materialization
    assert plan_group_stats(st, ["device_type", "device_id"], static_groups=5).groups is None


def test_bucket_plan_broadcasts_stats_and_pushes_filters(spark):
    df = bucket_stats(fx.event_readings(spark, SF_SMALL), fx.START_MS, fx.END_MS, 10)
    df.collect()
    p = plan_text(df)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    scan = df._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in scan


def test_split_plan_has_no_whole_group_shuffle(skewed):
    df = device_type_stats(skewed, fx.START_MS, fx.END_MS, max_broadcast_rows=0)
    df.collect()
    p = plan_text(df)
    assert "BroadcastHashJoin" in p  # hot groups: statistics broadcast, readings not shuffled
    assert "LeftAnti" in p and "ShuffledHashJoin" in p  # cold groups: shuffled on the group key


def test_read_hours_prunes_partitions(spark, tmpdir_path):
    from pyspark.sql import functions as F

    r = fx.event_readings(spark, SF_SMALL).withColumn("ingest_ts", F.col("ts").cast("timestamp"))
    path = tmpdir_path + "/hours"
    write_hourly_readings_batch(hourly_distinct_readings(r, "ingest_ts"), path)
    df = read_hours(spark, path, fx.START_MS + 86_400_000, fx.START_MS + 2 * 86_400_000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    days = {x.event_day for x in df.select("event_day").distinct().collect()}
    assert days == {fx.START_MS // 86_400_000 + 1, fx.START_MS // 86_400_000 + 2}


def test_read_hours_outside_stored_range_is_empty(spark, tmpdir_path):
    from pyspark.sql import functions as F

    r = fx.event_readings(spark, SF_SMALL).withColumn("ingest_ts", F.col("ts").cast("timestamp"))
    path = tmpdir_path + "/hours"
    write_hourly_readings_batch(hourly_distinct_readings(r, "ingest_ts"), path)
    far = fx.END_MS + 400 * 86_400_000
    df = read_hours(spark, path, far, far + 3_600_000)
    assert df.count() == 0 and "hour_end_ms" in df.columns
    wide = read_hours(spark, path, fx.START_MS - 200 * 86_400_000, fx.END_MS)
    assert wide.count() == hourly_distinct_readings(r, "ingest_ts").count()


def test_cluster_conf_sizes(spark):
    from devicelens.plans.group_join import broadcast_bytes
    from devicelens.session import cluster_conf

    # the statistics of 100 TB of readings: some 400,000 map tasks x 1,000 groups x 100 bytes
    conf = cluster_conf(400_000 * 1000 * 100, executors=1000, cores_per_executor=8)
    assert int(conf["spark.sql.shuffle.partitions"]) == 16_000  # two waves of tasks
    cold = cluster_conf(10 * 2**40, executors=1000, cores_per_executor=8)
    assert int(cold["spark.sql.shuffle.partitions"]) == 10 * 2**40 // (256 << 20)  # ~256 MB shuffled each
    small = cluster_conf(2**30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # never fewer than two waves of tasks
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf["spark.sql.autoBroadcastJoinThreshold"])
        assert broadcast_bytes(spark) == 64 << 20  # the measured strategy reads the same budget
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_split_without_hot_groups_scans_once(spark, monkeypatch):
    monkeypatch.setattr(group_join, "HOT_GROUPS", 4)
    r = fx.event_readings(spark, SF_SMALL)  # 150 devices x 5 types, none near a quarter of the readings
    df = device_type_stats(r, fx.START_MS, fx.END_MS, max_broadcast_rows=0)
    df.collect()
    p = plan_text(df)
    assert "ShuffledHashJoin" in p and "LeftAnti" not in p
    final = p.split("== Initial Plan ==")[0]  # AQE prints the final plan, then the initial one
    assert final.count("Scan parquet") == 1
    assert rows(df) == rows(device_type_stats(r, fx.START_MS, fx.END_MS))


def test_registered_hot_entry_takes_the_hot_branch(spark, monkeypatch):
    from devicelens import registry

    seen = []
    real = group_join._split_join

    def spy(r, gs, stat_cols, count_col):
        seen.append(gs.largest > (gs.rows or 0) // group_join.HOT_GROUPS)
        return real(r, gs, stat_cols, count_col)

    monkeypatch.setattr(group_join, "_split_join", spy)
    for name in ("usual_counts_hot", "recent_device_split", "bucket_stats_split"):
        registry.QUERIES[name](spark, SF_SMALL)
    assert seen == [True, True, True]


def test_uncommitted_files_are_not_read(spark, tmpdir_path):
    """A file that a lost batch left in a streamed table is not data; a batch does not append there."""
    import glob
    import os
    import shutil

    from devicelens.registry import _messages
    from devicelens.sources.messages import message_file_stream, message_records
    from devicelens.streaming import run_ingest

    src, path = tmpdir_path + "/in", tmpdir_path + "/readings"
    _messages(fx.event_readings(spark, SF_SMALL)).write.json(src)
    run_ingest(message_records(message_file_stream(spark, src), "value", "ingest_ts"), path, tmpdir_path + "/ckpt",
               trigger={"availableNow": True}, time_source="record").awaitTermination()
    want = read_hours(spark, path, fx.START_MS, fx.END_MS).count()
    one = glob.glob(path + "/event_day=*/hour_end_ms=*/part-*.parquet")[0]
    shutil.copy(one, os.path.join(os.path.dirname(one), "part-99999-lost.parquet"))
    assert read_hours(spark, path, fx.START_MS, fx.END_MS).count() == want == fx.event_readings(spark, SF_SMALL).count()
    with pytest.raises(ValueError):
        write_hourly_readings_batch(read_hours(spark, path, fx.START_MS, fx.END_MS).drop("event_day"), path)


def test_late_and_far_readings_are_found(spark, tmpdir_path, readings):
    from pyspark.sql import functions as F

    day = 86_400_000
    t = fx.START_MS
    r = readings([(1, "t", "late", 1.0, t + 5), (1, "t", "ahead", 2.0, t + 6), (1, "t", "far", 3.0, t - 400 * day),
                  (1, "t", "nano", 4.0, t * 1_000_000), (1, "t", "neg", 5.0, -5)])
    r = r.withColumn("hour_end_ms", F.when(F.col("device_id") == "late", F.lit(t + 9 * day))
                     .when(F.col("device_id") == "ahead", F.lit(t - 2 * day)).otherwise(F.lit(t)))
    path = tmpdir_path + "/hours"
    write_hourly_readings_batch(r, path)
    def found(s, e):
        from devicelens.operators import filter_time_range

        return {x.device_id for x in filter_time_range(read_hours(spark, path, s, e), s, e).collect()}

    assert found(t, t + day) == {"late", "ahead"}
    assert found(t - 401 * day, t - 399 * day) == {"far"}
    assert found(-10, 0) == {"neg"}
    assert found(t * 1_000_000 - 1, t * 1_000_000 + 1000) == {"nano"}


def test_compaction_keeps_the_readings(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from devicelens.streaming.ingest import compact_hours

    r = fx.event_readings(spark, SF_SMALL).withColumn("ingest_ts", F.col("ts").cast("timestamp"))
    src, out = tmpdir_path + "/hours", tmpdir_path + "/compact"
    write_hourly_readings_batch(hourly_distinct_readings(r, "ingest_ts"), src)
    for _ in range(2):  # a second run replaces what the first wrote
        compact_hours(spark, src, out, 0, fx.END_MS + 400 * 86_400_000)
    a, b = spark.read.parquet(src), spark.read.parquet(out)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
