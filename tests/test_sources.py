"""Message parsing (E12, 2.8), text lines (E13, E14) and round trips."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from devicelens import fixtures as fx
from devicelens.registry import _messages
from devicelens.schema import READING_FIELDS
from devicelens.sources import format_reading_lines, parse_device_messages, parse_reading_lines

from conftest import SF_SMALL

GOOD = {"key": "t", "value": 1.5, "ts": 1000}


def parse(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return [tuple(r) for r in parse_device_messages(df).select(*READING_FIELDS).collect()]


def msg(**kw):
    m = {"tenantId": 7, "deviceId": "d-1", "data": [GOOD]}
    m.update(kw)
    return json.dumps(m)


def test_good_message(spark):
    text = msg(data=[GOOD, {"key": "h", "value": 3, "ts": 1001}])
    assert parse(spark, [text]) == [(7, "t", "d-1", 1.5, 1000), (7, "h", "d-1", 3.0, 1001)]


@pytest.mark.parametrize(
    "text",
    [
        "not json",
        json.dumps([{"tenantId": 7}]),
        json.dumps({"tenantId": 7, "deviceId": "d"}),
        json.dumps({"tenantId": 7, "deviceId": "d", "data": "x"}),
        json.dumps({"tenantId": 7, "deviceId": "d", "data": {"key": "t"}}),
        json.dumps({"tenantId": "7", "deviceId": "d", "data": [GOOD]}),
        json.dumps({"deviceId": "d", "data": [GOOD]}),
        json.dumps({"tenantId": 7, "data": [GOOD]}),
        json.dumps({"tenantId": 7, "deviceId": None, "data": [GOOD]}),
        json.dumps({"tenantId": 7, "deviceId": "d", "data": []}),
        '{"tenantId": 7, "deviceId": "d", "data": [{"key": "t", "value": 1, "ts": 1}',  # truncated
    ],
)
def test_messages_without_readings(spark, text):
    assert parse(spark, [text]) == []


@pytest.mark.parametrize(
    "bad",
    [None, 5, "x", {"key": "t", "value": "2", "ts": 2}, {"key": "t", "value": "NaN", "ts": 2},
     {"value": 2, "ts": 2}, {"key": None, "value": 2, "ts": 2}, {"key": "t", "ts": 2},
     {"key": "t", "value": 2, "ts": "2"}, {"key": "t", "value": None, "ts": 2}],
)
def test_prefix_before_first_bad_element(spark, bad):  # E12
    text = msg(data=[GOOD, {"key": "u", "value": 2, "ts": 1001}, bad, {"key": "w", "value": 9, "ts": 9}])
    assert parse(spark, [text]) == [(7, "t", "d-1", 1.5, 1000), (7, "u", "d-1", 2.0, 1001)]


def test_number_truncation_and_numeric_device(spark):  # rule 3, D7
    text = json.dumps({"tenantId": 7.9, "deviceId": 5, "data": [{"key": "t", "value": 2, "ts": 1000.7}]})
    assert parse(spark, [text]) == [(7, "t", "5", 2.0, 1000)]


def test_messages_round_trip(spark):
    r = fx.event_readings(spark, SF_SMALL).select(*READING_FIELDS)
    back = parse_device_messages(_messages(fx.event_readings(spark, SF_SMALL))).select(*READING_FIELDS)
    assert back.exceptAll(r).count() == 0 and r.exceptAll(back).count() == 0


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_lines_accepted_shapes(spark):  # E14
    df = lines(spark, ["1,t,d,2.5,1000", "2,t,d,1.0E10,1001,,", '3,,d,1,1002', '4,"k,d,-1,1003'])
    got = [tuple(r) for r in parse_reading_lines(df).select(*READING_FIELDS).collect()]
    assert got == [(1, "t", "d", 2.5, 1000), (2, "t", "d", 1.0e10, 1001), (3, "", "d", 1.0, 1002),
                   (4, '"k', "d", -1.0, 1003)]


@pytest.mark.parametrize("bad", ["1,t,d,2.5", "1,t,d,2.5,1000,x", "1,t,d,abc,1000", "x,t,d,1,1000",
                                 "1,t,d,1,10.5", ""])
def test_lines_failfast(spark, bad):  # E13
    df = lines(spark, ["1,t,d,2.5,1000", bad])
    with pytest.raises(PySparkException):
        parse_reading_lines(df).select("device_id").collect()  # checks survive column pruning


def test_lines_permissive(spark):  # D1
    df = lines(spark, ["1,t,d,2.5,1000", "1,t,d,2.5", "1,t,d,x,1"])
    good, bad = parse_reading_lines(df, mode="PERMISSIVE")
    assert good.count() == 1
    assert sorted(r.line for r in bad.collect()) == ["1,t,d,2.5", "1,t,d,x,1"]


def test_lines_round_trip(spark):
    r = fx.event_readings(spark, SF_SMALL).select(*READING_FIELDS)
    back = parse_reading_lines(format_reading_lines(r)).select(*READING_FIELDS)
    assert back.exceptAll(r).count() == 0 and r.exceptAll(back).count() == 0


def test_lines_from_files(spark, tmpdir_path):
    from devicelens.sources import read_reading_lines

    r = fx.event_readings(spark, SF_SMALL)
    format_reading_lines(r).write.text(tmpdir_path + "/lines")
    back = read_reading_lines(spark, tmpdir_path + "/lines/*.txt")
    assert back.count() == r.count()
    assert back.agg(F.sum("value")).first()[0] == pytest.approx(r.agg(F.sum("value")).first()[0])


@pytest.mark.parametrize("lo,hi", [(0, 0), (5, 5), (120, 4999), (1704063600000, 1706666400000),
                                   (1704063600000, 1704063600000 + 3_600_000), (999, 1000), (1, 10**13 - 1)])
def test_prefix_cover_is_exact(lo, hi):
    from devicelens.sources import prefix_cover

    cover = prefix_cover(lo, hi, 13)
    total = 0
    for p in cover:
        stem = p.rstrip("?")
        k = 13 - len(stem)
        first = int(stem) * 10**k
        assert lo <= first and first + 10**k - 1 <= hi
        total += 10**k
    assert total == hi - lo + 1  # disjoint pieces that add up to the range
    assert len(cover) <= 2 * 9 * 13


def test_read_text_hours(spark, tmpdir_path):
    from devicelens.sources import read_text_hours

    h = 3_600_000
    base = 1704067200000
    root = tmpdir_path + "/text"
    for i in range(6):  # one folder per hourly window, ending at base + i h
        T = base + i * h
        rows = [f"1,t,d,{i}.0,{T - 1000}", f"1,t,d,{i}.5,{T - 2000}"]
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(
            f"{root}/device-data-{T}")
    got = read_text_hours(spark, root, base + 2 * h, base + 3 * h, pad_hours=0)
    # windows ending in [start, end + 1 h] = hours 2, 3, 4
    assert sorted(r.value for r in got.collect()) == [2.0, 2.5, 3.0, 3.5, 4.0, 4.5]
    assert read_text_hours(spark, root, base + 100 * h, base + 101 * h, pad_hours=1).count() == 0
    # by default every folder is read: a reading can arrive at any time after its own
    assert read_text_hours(spark, root, base + 100 * h, base + 101 * h).count() == 12
    assert read_text_hours(spark, tmpdir_path + "/nothing", base, base + h).count() == 0


def test_text_after_complete_message_is_ignored(spark):  # D11
    text = msg() + " trailing"
    assert parse(spark, [text]) == [(7, "t", "d-1", 1.5, 1000)]



@pytest.mark.parametrize("lo,hi", [(0, 0), (0, 130), (7, 12345), (95, 105), (3_600_000, 7_200_000 * 1000)])
def test_range_alternatives_match_exactly(lo, hi):
    import fnmatch
    import random

    from devicelens.sources import range_alternatives

    alts = range_alternatives(lo, hi)

    def matches(n):
        return any(fnmatch.fnmatchcase(str(n), a) for a in alts)

    rng = random.Random(7)
    probes = {lo, hi, lo - 1, hi + 1, 0, 9, 10, 99, 100} | {rng.randint(0, hi * 2 + 10) for _ in range(2000)}
    for n in probes:
        if n >= 0:
            assert matches(n) == (lo <= n <= hi), n
    assert len(alts) <= 2 * 9 * len(str(hi)) + 2


def test_numbers_beyond_long_and_timestamp(spark):
    el = lambda v, ts: '{"key":"t","value":%s,"ts":%s}' % (v, ts)
    def message(*els, tenant="7"):
        return '{"tenantId":%s,"deviceId":"d","data":[%s]}' % (tenant, ",".join(els))

    big = (1 << 63) - 1
    rows = parse_device_messages(spark.createDataFrame(
        [(message(el("1", "1704067200000000000"), el("2", "1e400"), el("3", "5")),),
         (message(el("1", "-9.3e18"), tenant="1e300"),)], "value string")).collect()
    assert sorted((r.tenant_id, r.value, r.time_stamp, r.ts is None) for r in rows) == [
        (7, 1.0, 1704067200000000000, True), (7, 2.0, big, True), (7, 3.0, 5, False), (big, 1.0, -(1 << 63), True)]


@pytest.mark.parametrize("tail", ["", ',{"key":"t"}', ",7", ",null"])
def test_verdict_does_not_depend_on_neighbours(spark, tail):
    good = '{"key":"t","value":1,"ts":5}'
    text = '{"tenantId":7,"deviceId":"d","data":[%s,{"key":"t","value":1e400,"ts":5},%s%s]}' % (good, good, tail)
    assert [r[3] for r in parse(spark, [text])] == [1.0, float("inf"), 1.0]
    text = '{"tenantId":7,"deviceId":"d","data":[%s,{"key":"t","value":"Infinity","ts":5},%s%s]}' % (good, good, tail)
    assert [r[3] for r in parse(spark, [text])] == [1.0]


def test_lines_with_nanoseconds_and_one_split(spark):
    df = lines(spark, ["1,t,d,2.5,1704067200000000000", "+2,t,d,1,007"])
    got = parse_reading_lines(df)
    assert [(r.tenant_id, r.time_stamp, r.ts is None) for r in got.collect()] == [(1, 1704067200000000000, True), (2, 7, False)]
    good, bad = parse_reading_lines(lines(spark, ["1,t,d,1, 5", "1,t,d,1,5"]), mode="PERMISSIVE")
    assert good.count() == 1 and bad.count() == 1
    assert got._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
