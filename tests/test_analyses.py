"""Edge semantics of the four analyses."""

import pytest

from devicelens.operators import bucket_stats, device_type_stats, recent_data, recent_device

S = 1_000_000
E = S + 1000
DAY = 86_400_000


def by_key(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.asDict() for r in df.collect()}


def test_single_reading_is_usual_in_recent(readings):  # E1
    df = readings([(1, "t", "d1", 5.0, S)])
    (r,) = recent_data(df, S, 1).collect()
    assert (r.data_count, r.usual_data_count, r.usual_data_rate, r.stddev_value) == (1, 1, 1.0, 0.0)
    (d,) = recent_device(df, S, 1).collect()
    assert (d.device_count, d.data_count, d.usual_data_count, d.usual_data_rate) == (1, 1, 1, 1.0)


def test_equal_readings_vanish_in_recent(readings):  # E2
    df = readings([(1, "t", "d1", 5.0, S), (1, "t", "d2", 5.0, S + 1), (2, "t", "d1", 1.0, S)])
    out = by_key(recent_data(df, S + 10, 1), "tenant_id", "device_type")
    assert list(out) == [(2, "t")]
    assert by_key(recent_device(df, S + 10, 1), "tenant_id", "device_type").keys() == {(2, "t")}


@pytest.mark.parametrize("v", [5.0, 0.1])
def test_constant_group_is_all_usual(readings, v):  # E3: 0.1 is the rounding trap
    df = readings([(1, "t", "d1", v, S), (1, "t", "d1", v, S + 1), (1, "t", "d1", v, S + 2)])
    (b,) = bucket_stats(df, S, E, 1).collect()
    assert (b.data_count, b.usual_data_count, b.usual_data_rate, b.stddev_value) == (3, 3, 1.0, 0.0)
    (d,) = device_type_stats(df, S, E).collect()
    assert (d.device_count, d.data_count, d.usual_data_count) == (1, 3, 3)


def test_outlier_outside_three_sigma(readings):
    rows = [(1, "t", "d1", 10.0, S + i) for i in range(20)] + [(1, "t", "d1", 1000.0, S + 20)]
    df = readings(rows)
    (b,) = bucket_stats(df, S, E, 1).collect()
    assert (b.data_count, b.usual_data_count, b.max_value, b.min_value) == (21, 20, 1000.0, 10.0)
    assert b.usual_data_rate == pytest.approx(20 / 21)
    (r,) = recent_data(df, E, 1).collect()
    assert (r.data_count, r.usual_data_count) == (21, 20)


def test_range_bounds(readings):  # E4
    df = readings([(1, "t", "d", float(i), t) for i, t in enumerate([S - 1, S, E - 1, E, E + 1])])
    (b,) = bucket_stats(df, S, E, 1).collect()
    assert b.data_count == 2
    (d,) = device_type_stats(df, S, E).collect()
    assert d.data_count == 3
    (r,) = recent_device(df, E, 1).collect()  # [E - 1 day, E]
    assert r.data_count == 4  # S - 1 is inside the day as well


def test_empty_buckets_absent(readings):  # E5
    df = readings([(1, "t", "d", 1.0, S), (1, "t", "d", 2.0, E - 1)])
    out = by_key(bucket_stats(df, S, E, 5), "bucket_start")
    assert sorted(out) == [S, S + 800]


def test_part_num_rules(readings):  # E6, E7
    df = readings([(1, "t", "d", float(i), S + i) for i in range(10)])
    assert [r.bucket_start for r in bucket_stats(df, S, S + 10, 0).collect()] == [S]
    assert sorted(r.bucket_start for r in bucket_stats(df, S, S + 10, 3).collect()) == [S, S + 4, S + 8]
    counts = by_key(bucket_stats(df, S, S + 10, 3), "bucket_start")
    assert counts[S + 8]["data_count"] == 2  # the last bucket is shorter
    assert sorted(r.bucket_start for r in bucket_stats(df, S, S + 3, 10).collect()) == [S, S + 1, S + 2]


def test_empty_range(readings):  # E8
    df = readings([(1, "t", "d", 1.0, S)])
    assert bucket_stats(df, S, S, 4).count() == 0
    assert bucket_stats(df, S + 5, S, 4).count() == 0


def test_device_counted_once_across_tenants(readings):  # E9
    df = readings([(1, "t", "d", 1.0, S), (2, "t", "d", 2.0, S + 1), (2, "t", "e", 2.0, S + 1)])
    (d,) = device_type_stats(df, S, E).collect()
    assert (d.device_count, d.data_count) == (2, 3)


def test_device_sigma_is_per_device(readings):  # E10
    # Device a: 20 x 10 and one 1000 (an outlier for a); device b: all 1000.
    rows = [(1, "t", "a", 10.0, S + i) for i in range(20)] + [(1, "t", "a", 1000.0, S + 20)]
    rows += [(1, "t", "b", 1000.0, S + i) for i in range(30)]
    (d,) = device_type_stats(readings(rows), S, E).collect()
    assert (d.device_count, d.data_count, d.usual_data_count) == (2, 51, 50)


def test_identity_filters(readings):
    df = readings([(1, "t", "d", 1.0, S), (2, "t", "d", 2.0, S), (1, "u", "d", 3.0, S), (1, "t", "x", 4.0, S)])
    (b,) = bucket_stats(df, S, E, 1, tenant_id=1, device_type="t", device_id="d").collect()
    assert b.data_count == 1 and b.max_value == 1.0
    (b,) = bucket_stats(df, S, E, 1, tenant_id="-1", device_type="t").collect()
    assert b.data_count == 3
    assert {r.device_type for r in device_type_stats(df, S, E, tenant_id=2).collect()} == {"t"}


def test_recent_days_are_64_bit(readings):  # D3: 30 days overflows a 32-bit product
    end = 40 * DAY
    df = readings([(1, "t", "d", 1.0, end - 29 * DAY), (1, "t", "d", 2.0, end - 31 * DAY)])
    (r,) = recent_device(df, end, 30).collect()
    assert r.data_count == 1


def test_usual_counts_rollup(readings):
    from devicelens.operators import group_stats, usual_counts, usual_rate

    rows = [(1, "t", "a", 10.0, S + i) for i in range(20)] + [(1, "t", "a", 1000.0, S + 20)]
    rows += [(1, "t", "b", 5.0, S), (2, "u", "c", 1.0, S)]
    df = readings(rows)
    st = group_stats(df, ["device_type", "device_id"])
    got = by_key(usual_counts(df, st, ["device_type", "device_id"], rollup=["device_type"]), "device_type")
    assert {k: v["usual_data_count"] for k, v in got.items()} == {"t": 21, "u": 1}
    tenants = group_stats(df, ["tenant_id"], ddof=1).select("tenant_id", "data_count")
    u = usual_counts(df, group_stats(df, ["tenant_id"], ddof=1), ["tenant_id"], ddof=1)
    rate = by_key(usual_rate(tenants.join(u, "tenant_id")), "tenant_id")
    assert rate[2]["usual_data_rate"] == 1.0 and rate[1]["data_count"] == 22


def test_non_numeric_tenant_matches_nothing(readings):
    df = readings([(1, "t", "d", 1.0, S)])
    assert bucket_stats(df, S, E, 1, tenant_id="abc").count() == 0


def test_nan_reading_follows_spark_ordering(readings):  # D8
    import math

    df = readings([(1, "t", "d", 1.0, S), (1, "t", "d", float("nan"), S + 1)])
    (b,) = bucket_stats(df, S, E, 1).collect()
    # NaN is the largest value; min skips it; mean and sd are NaN, and NaN <= NaN holds,
    # so both readings are usual.
    assert math.isnan(b.max_value) and b.min_value == 1.0 and math.isnan(b.mean_value)
    assert (b.data_count, b.usual_data_count) == (2, 2)


def test_bucket_start_is_a_floor(readings):
    from devicelens.operators import assign_time_bucket

    df = readings([(1, "t", "d", 0.0, t) for t in [S - 301, S - 1, S, S + 299, S + 300, S + 1001]])
    got = [r.bucket_start for r in assign_time_bucket(df, S, S + 900, 3).orderBy("time_stamp").collect()]
    assert got == [S - 600, S - 300, S, S, S + 300, S + 900]
