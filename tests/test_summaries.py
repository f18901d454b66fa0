"""Analyses from mergeable hourly summaries equal those from readings."""

import math
import random

import pytest
from pyspark.sql import functions as F

from devicelens import bucket_stats, device_type_stats, recent_data, recent_device, write_hourly_readings_batch
from devicelens.operators import group_stats
from devicelens.operators.summaries import (
    bucket_stats_summarised, device_type_stats_summarised, hourly_summary, merged_stats, recent_data_summarised,
    recent_device_summarised,
)
from devicelens.schema import DEVICE, HOUR_END, TENANT, TYPE
from devicelens.sources import read_hours
from devicelens.sources.summaries import SummarisedTable
from devicelens.streaming.compaction import compact_table, merge_generations

H = 3_600_000
DAY = 24 * H
S = 1_704_067_200_000


def same(a, b, keys):
    a, b = ({tuple(r[k] for k in keys): r.asDict() for r in df.collect()} for df in (a, b))
    assert a.keys() == b.keys() and a
    for k, x in a.items():
        for c, v in x.items():
            w = b[k][c]
            close = isinstance(v, float) and isinstance(w, float) and (math.isclose(v, w, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(v) and math.isnan(w)))
            assert v == w or close, (k, c, v, w)


def rows(n=3000, days=4, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        tenant, kind, device = rng.randrange(3), rng.choice(["t", "h", "p"]), f"d{rng.randrange(12)}"
        value = {"t": 20.0 + tenant, "h": 1e6, "p": 0.5}[kind]
        if kind != "p":  # all of type p are equal
            value += rng.gauss(0, 1) * (1e-3 if kind == "h" else 1) + (40 if rng.random() < 0.01 else 0)
        out.append((tenant, kind, device, value, S + rng.randrange(days * DAY)))
    return out + [(9, "one", "x", 5.0, S + 5), (9, "two", "x", 5.0, S + DAY), (9, "two", "x", 6.0, S + 2 * DAY), (8, "edge", "e", 1.0, S + 4 * DAY)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A table with two generations, of which one was merged, live hours, and late rows apart."""
    from devicelens.functions.timecols import ms_to_ts
    from devicelens.schema import READINGS

    path, late = (f"{tmp_path_factory.mktemp('s')}/{x}" for x in ("t", "late"))
    r = spark.createDataFrame(rows(), READINGS).withColumn("ts", ms_to_ts("time_stamp"))
    # a tenth arrives hours later than its own time
    wait = F.when(F.pmod(F.xxhash64("value", "time_stamp"), 10) == 0, 5 * H).otherwise(0)
    r = r.withColumn(HOUR_END, F.expr(f"time_stamp - pmod(time_stamp, {H}) + {H}") + wait)
    is_late = F.pmod(F.xxhash64("time_stamp"), 50) == 0
    write_hourly_readings_batch(r.where(is_late), late)
    for k, (a, b) in enumerate([(0, 1.2), (1.2, 2), (2, 3), (3, 9)]):
        write_hourly_readings_batch(r.where(~is_late & F.col(HOUR_END).between(int(S + a * DAY) + 1, int(S + b * DAY))), path)
        if k < 3:
            compact_table(spark, path)
    merge_generations(spark, path, int(S + 1.9 * DAY))
    return path, late, read_hours(spark, path, 0, S + 99 * DAY, late_path=late).cache()


def test_merged_moments_equal_direct_ones(spark, stored):
    readings = stored[2]
    summary = hourly_summary(readings)
    assert summary.count() < readings.count() and summary.agg(F.sum("n")).first()[0] == readings.count()
    for keys in ([TENANT, TYPE], [TYPE, DEVICE], [TYPE]):
        for ddof in (0, 1):
            for hot in (None, 0):
                same(merged_stats(summary, keys, ddof, distinct_devices=DEVICE not in keys, max_broadcast_rows=hot),
                     group_stats(readings, keys, ddof, distinct_devices=DEVICE not in keys), keys)


@pytest.mark.parametrize("hot", [None, 0])
def test_analyses_from_summaries(spark, stored, hot):
    path, late, readings = stored
    table = SummarisedTable(spark, path, late)
    e = S + 4 * DAY
    same(bucket_stats_summarised(table, S, e, 8, max_broadcast_rows=hot), bucket_stats(readings, S, e, 8), ["bucket_start"])
    same(bucket_stats_summarised(table, S, e, 1, 1, "t"), bucket_stats(readings, S, e, 1, 1, "t"), ["bucket_start"])
    same(device_type_stats_summarised(table, S, e, max_broadcast_rows=hot), device_type_stats(readings, S, e), [TYPE])
    same(device_type_stats_summarised(table, S + 7, e - 100 * 60_000, 1), device_type_stats(readings, S + 7, e - 100 * 60_000, 1), [TYPE])
    # whole hours and a last millisecond; ends inside an hour; a range inside one hour
    for end, days in ((e, 1), (e, 3), (e - 1234567, 2), (S + 2 * DAY + 17, 1)):
        same(recent_data_summarised(table, end, days, max_broadcast_rows=hot), recent_data(readings, end, days), [TENANT, TYPE])
        same(recent_device_summarised(table, end, days, max_broadcast_rows=hot), recent_device(readings, end, days), [TENANT, TYPE])
    a, b = S + DAY + 10 * 60_000, S + DAY + 50 * 60_000
    got = table.summary(a, b, "left")
    assert got.agg(F.sum("n")).first()[0] == readings.where(F.col("time_stamp").between(a, b - 1)).count() > 0
    with pytest.raises(ValueError):
        bucket_stats_summarised(table, S, S + DAY, 48)


def test_folders_inside_the_band_are_not_read(spark, stored):
    """Pass 2 reads the hours with a reading near or beyond the band, and none where there is no such hour."""
    path, late, readings = stored
    asked = []

    class Counted(SummarisedTable):
        def readings(self, *a, **k):
            out = super().readings(*a, **k)
            asked.append(out.count())
            return out

    table, e = Counted(spark, path, late), S + 4 * DAY
    same(bucket_stats_summarised(table, S, e, 2, None, "t"), bucket_stats(readings, S, e, 2, None, "t"), ["bucket_start"])
    whole = readings.where(F.col("device_type") == "t").count()
    assert len(asked) == 1 and asked[0] < 0.7 * readings.count() and whole > 0
    asked.clear()
    same(recent_data_summarised(Counted(spark, path, late), S + 2 * DAY, 2).where("tenant_id = 9"),
         recent_data(readings, S + 2 * DAY, 2).where("tenant_id = 9"), [TENANT, TYPE])
    asked.clear()
    same(bucket_stats_summarised(table, S, e, 2, None, "p"), bucket_stats(readings, S, e, 2, None, "p"), ["bucket_start"])
    assert asked == []  # equal readings: the summaries tell all


def test_nan_and_infinite_values(spark, readings, tmpdir_path):
    r = readings([(1, "t", "d", v, S + k * H) for k, v in enumerate([1.0, float("nan"), 2.0, 3.0])] + [(1, "u", "d", v, S + k) for k, v in enumerate([1.0, 2.0])])
    write_hourly_readings_batch(r.withColumn(HOUR_END, F.expr(f"time_stamp - pmod(time_stamp, {H}) + {H}")), tmpdir_path + "/t")
    compact_table(spark, tmpdir_path + "/t")
    table = SummarisedTable(spark, tmpdir_path + "/t")
    same(bucket_stats_summarised(table, S, S + DAY, 1, None, "u"), bucket_stats(r, S, S + DAY, 1, None, "u"), ["bucket_start"])
    a, b = recent_data_summarised(table, S + DAY, 1), recent_data(r, S + DAY, 1)
    assert sorted(x[TYPE] for x in a.collect()) == sorted(x[TYPE] for x in b.collect())
    assert table.summary(0, S - 1).count() == 0
