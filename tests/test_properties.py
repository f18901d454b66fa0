"""Random readings against an exact brute force (Fraction arithmetic).

A reading exactly on the 3-sigma boundary may fall either way in floating
point (the reference's own two-pass sd and Spark's differ in the last bit),
so the usual count is checked to lie between the readings that are
certainly usual and those plus the boundary ones."""

from collections import defaultdict
from fractions import Fraction
from math import isqrt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from devicelens.operators import bucket_stats, recent_data

S, WIDTH, PARTS = 1_000_000, 1_000, 4


def props(n: int):
    """Fixed example sets (reproducible runs); wider random sweeps are run by hand."""
    return settings(max_examples=n, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
DAY = 86_400_000

reading = st.tuples(
    st.integers(0, 2),  # tenant
    st.sampled_from(["a", "b"]),  # type
    st.one_of(st.integers(0, 5), st.integers(0, 5), st.sampled_from([100, -50])),  # value, rare outliers
    st.integers(-20, WIDTH + 20),  # time offset (some outside the range)
)


def sqrt_bounds(x: Fraction):
    """(lo, hi) with lo <= sqrt(x) <= hi, to 1e-12 relative."""
    scale = 10**24
    r = isqrt(x.numerator * scale * scale // x.denominator)
    return Fraction(r, scale), Fraction(r + 1, scale)


def usual_bounds(values, ddof):
    n = len(values)
    vals = [Fraction(v) for v in values]
    mean = sum(vals) / n
    if ddof == 1 and n == 1:
        return 1, 1
    ss = sum((v - mean) ** 2 for v in vals) / (n - ddof)
    if ss == 0:
        return (n, n) if ddof == 0 else (0, 0)
    lo_sd, hi_sd = sqrt_bounds(ss)
    eps = Fraction(1, 10**9) * (abs(mean) + hi_sd + 1)
    sure = sum(1 for v in vals if abs(v - mean) < 3 * lo_sd - eps)
    maybe = sum(1 for v in vals if 3 * lo_sd - eps <= abs(v - mean) <= 3 * hi_sd + eps)
    if ddof == 0:  # inclusive rule: the boundary itself counts
        return sure, sure + maybe
    return sure, sure + maybe


@props(12)
@given(rows=st.lists(reading, min_size=1, max_size=40))
def test_bucket_stats_against_brute_force(readings, rows):
    df = readings([(t, k, "d", float(v), S + off) for t, k, v, off in rows])
    got = {r.bucket_start: r for r in bucket_stats(df, S, S + WIDTH, PARTS).collect()}
    gap = WIDTH // PARTS
    groups = defaultdict(list)
    for _, _, v, off in rows:
        if 0 <= off < WIDTH:
            groups[S + off // gap * gap].append(v)
    assert set(got) == set(groups)
    for b, vals in groups.items():
        r = got[b]
        assert r.data_count == len(vals) and r.max_value == max(vals) and r.min_value == min(vals)
        assert r.mean_value == pytest.approx(sum(vals) / len(vals))
        lo, hi = usual_bounds(vals, 0)
        assert lo <= r.usual_data_count <= hi
        assert r.usual_data_rate == pytest.approx(r.usual_data_count / len(vals))


@props(12)
@given(rows=st.lists(reading, min_size=1, max_size=40))
def test_recent_data_against_brute_force(readings, rows):
    end = S + DAY

    def at(off):  # half the offsets land around the day's start, half around its end
        return end - DAY + off - 10 if off < WIDTH // 2 else end - WIDTH + off

    df = readings([(t, k, "d", float(v), at(off)) for t, k, v, off in rows])
    got = {(r.tenant_id, r.device_type): r for r in recent_data(df, end, 1).collect()}
    groups = defaultdict(list)
    for t, k, v, off in rows:
        if end - DAY <= at(off) <= end:  # closed range [end - 1 day, end]
            groups[(t, k)].append(v)
    for key, vals in groups.items():
        lo, hi = usual_bounds(vals, 1)
        if key not in got:
            assert lo == 0  # absent only when no reading is surely usual
            continue
        r = got[key]
        assert r.data_count == len(vals) and lo <= r.usual_data_count <= hi
        assert r.usual_data_count > 0
    assert set(got) <= set(groups)


device_reading = st.tuples(
    st.sampled_from(["a", "b"]),  # type
    st.sampled_from(["d1", "d2", "d3"]),  # device
    st.one_of(st.integers(0, 5), st.integers(0, 5), st.sampled_from([100, -50])),
    st.integers(-20, WIDTH + 20),
)


@props(10)
@given(rows=st.lists(device_reading, min_size=1, max_size=40))
def test_device_type_stats_against_brute_force(readings, rows):
    from devicelens.operators import device_type_stats

    df = readings([(1, k, d, float(v), S + off) for k, d, v, off in rows])
    got = {r.device_type: r for r in device_type_stats(df, S, S + WIDTH).collect()}
    # the split strategy (hot groups broadcast, cold ones shuffled) gives the same rows
    split = {r.device_type: r for r in device_type_stats(df, S, S + WIDTH, max_broadcast_rows=0).collect()}
    assert split == got
    per_device = defaultdict(list)
    for k, d, v, off in rows:
        if 0 <= off <= WIDTH:  # closed range
            per_device[(k, d)].append(v)
    types = {k for k, _ in per_device}
    assert set(got) == types
    for k in types:
        devices = {d: vals for (kk, d), vals in per_device.items() if kk == k}
        lo = sum(usual_bounds(v, 0)[0] for v in devices.values())
        hi = sum(usual_bounds(v, 0)[1] for v in devices.values())
        r = got[k]
        assert r.device_count == len(devices) and r.data_count == sum(len(v) for v in devices.values())
        assert lo <= r.usual_data_count <= hi


# ---------------------------------------------------------------- messages

import json  # noqa: E402

from devicelens.schema import READING_FIELDS  # noqa: E402
from devicelens.sources import parse_device_messages  # noqa: E402

number = st.one_of(st.integers(-10**6, 10**6), st.floats(-1e6, 1e6, allow_nan=False).map(lambda x: round(x, 3)))
not_number = st.one_of(st.text(max_size=3), st.booleans(), st.none(), st.just([1]), st.just({"a": 1}))
good_element = st.fixed_dictionaries({"key": st.sampled_from(["t", "h", ""]), "value": number, "ts": number})
bad_element = st.one_of(
    st.none(), number, st.text(max_size=3),
    st.fixed_dictionaries({"key": st.sampled_from(["t"]), "value": not_number, "ts": number}),
    st.fixed_dictionaries({"key": st.sampled_from(["t"]), "value": number, "ts": not_number}),
    st.fixed_dictionaries({"value": number, "ts": number}),
    st.fixed_dictionaries({"key": st.none(), "value": number, "ts": number}),
)
message = st.fixed_dictionaries(
    {},
    optional={
        "tenantId": st.one_of(number, number, not_number),
        "deviceId": st.one_of(st.sampled_from(["d1", "d-2"]), st.sampled_from(["d1"]), st.none()),
        "data": st.one_of(st.lists(st.one_of(good_element, good_element, bad_element), max_size=5),
                          st.text(max_size=2), st.none()),
    },
)


def is_num(x):
    return isinstance(x, (int, float)) and not isinstance(x, bool)


def model(m):
    """The reference's rules, in plain Python."""
    out = []
    data = m.get("data")
    if not isinstance(data, list):
        return out
    for e in data:
        tenant, device = m.get("tenantId"), m.get("deviceId")
        if not is_num(tenant) or device is None or not isinstance(e, dict):
            break
        k, v, t = e.get("key"), e.get("value"), e.get("ts")
        if k is None or not is_num(v) or not is_num(t):
            break
        out.append((int(tenant), k, device, float(v), int(t)))
    return out


@props(8)
@given(msgs=st.lists(message, min_size=1, max_size=30))
def test_messages_against_model(spark, msgs):
    texts = [json.dumps(m) for m in msgs]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = sorted(tuple(r) for r in parse_device_messages(df).select(*READING_FIELDS).collect())
    want = sorted(r for m in msgs for r in model(m))
    assert got == want
