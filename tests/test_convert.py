"""The text layout into the stored table: again and again, with bad lines, after failures."""

import os

import pytest
from pyspark.sql import functions as F

from devicelens.schema import HOUR_END, READING_FIELDS
from devicelens.sources import read_hours
from devicelens.storage import load_snapshot
from devicelens.streaming import convert, write_hourly_readings_batch
from devicelens.streaming.compaction import merge_generations, remove_compacted

H = 3_600_000


def text(root, hour, lines, name="part-0"):
    os.makedirs(f"{root}/device-data-{hour * H}", exist_ok=True)
    with open(f"{root}/device-data-{hour * H}/{name}", "w") as f:
        f.write("".join(x + "\n" for x in lines))


def line(hour, k):
    return f"{k % 3},t,d{k},{hour}.5,{hour * H - 1000 + k}"


def content(spark, path):
    return sorted(tuple(r) for r in read_hours(spark, path, 0, 1 << 52).select(HOUR_END, *READING_FIELDS).collect())


def want(hours):
    return sorted((h * H, k % 3, "t", f"d{k}", h + 0.5, h * H - 1000 + k) for h, n in hours.items() for k in range(n))


def bad(spark, path):
    return sorted(tuple(r) for r in convert.read_bad_lines(spark, path).collect())


def test_convert_again_and_again(spark, tmpdir_path):
    root, out = f"{tmpdir_path}/text", f"{tmpdir_path}/t"
    for h in (5, 6, 30):
        text(root, h, [line(h, k) for k in range(4)] + (["not a reading", line(h, 0) + ",x"] if h == 6 else []))
    open(f"{root}/device-data-{6 * H}/_SUCCESS", "w").close()
    convert.convert_text(spark, root, out, folders=2)
    assert content(spark, out) == want({5: 4, 6: 4, 30: 4})
    assert bad(spark, out) == [(line(6, 0) + ",x", 6 * H), ("not a reading", 6 * H)]
    first = load_snapshot(spark, out)
    assert [g.hours for g in first.generations] == [[5 * H, 6 * H], [30 * H]]
    # nothing new: nothing is done
    assert convert.convert_text(spark, root, out) == first
    # a folder that has changed is replaced as a whole, a new one comes in, the rest is not read
    text(root, 6, [line(6, k) for k in range(7)] + ["worse", "worse"])
    text(root, 31, [line(31, 0)])
    os.rename(f"{root}/device-data-{5 * H}", f"{root}/gone")
    second = convert.convert_text(spark, root, out)
    assert content(spark, out) == want({5: 4, 6: 7, 30: 4, 31: 1})
    assert bad(spark, out) == [("worse", 6 * H), ("worse", 6 * H)]
    assert [g.hours for g in second.generations] == [[5 * H], [30 * H], [6 * H, 31 * H]]
    assert merge_generations(spark, out, 1 << 50) == second  # converted generations keep their ledger
    remove_compacted(spark, out, keep_ms=0)
    assert content(spark, out) == want({5: 4, 6: 7, 30: 4, 31: 1}) and len(bad(spark, out)) == 2


def test_convert_that_fails_half_way(spark, tmpdir_path, monkeypatch):
    root, out = f"{tmpdir_path}/text", f"{tmpdir_path}/t"
    for h in range(1, 6):
        text(root, h, [line(h, k) for k in range(3)])
    real, calls = convert.publish, []

    def failing(*a):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        return real(*a)

    monkeypatch.setattr(convert, "publish", failing)
    with pytest.raises(OSError):
        convert.convert_text(spark, root, out, folders=2)
    assert content(spark, out) == want({1: 3, 2: 3})  # what was written for the next two hours is not seen
    convert.convert_text(spark, root, out, folders=2)
    assert content(spark, out) == want({h: 3 for h in range(1, 6)})
    assert len(remove_compacted(spark, out, keep_ms=0)["generations"]) == 1
    assert content(spark, out) == want({h: 3 for h in range(1, 6)})


def test_hours_that_are_live_are_refused(spark, readings, tmpdir_path):
    root, out = f"{tmpdir_path}/text", f"{tmpdir_path}/t"
    rows = readings([(1, "t", "d", 1.0, H - 5)]).withColumn(HOUR_END, F.lit(H).cast("bigint"))
    write_hourly_readings_batch(rows, out)
    text(root, 1, [line(1, 0)])
    with pytest.raises(ValueError, match="live files"):
        convert.convert_text(spark, root, out)
    assert content(spark, out) == [(H, 1, "t", "d", 1.0, H - 5)] and bad(spark, out) == []
    os.rename(f"{root}/device-data-{H}", f"{root}/device-data-{9 * H}")
    convert.convert_text(spark, root, out)
    assert len(content(spark, out)) == 2
