"""JSON reports of the bucket and device-type analyses.

A report is one row with one ``value`` text, built by a single global
aggregate over the (small) statistics frame: one entry per bucket or device
type, never per reading.  Maps are keyed by the bucket start (as text) or the
device type, keys sorted.  Each map is rendered on its own and the pieces
concatenated, so counts print as integers and rates/means as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import BUCKET, COUNT, DEVICES, MAX, MEAN, MIN, NO_DATA_STATUS, OK_STATUS, RATE, STDDEV, TYPE, USUAL

# The report's member names and order.
BUCKET_METRICS = ["max", "min", "mean", "stdev", "count", "usualCount", "usualRate"]
DEVICE_METRICS = ["deviceCount", "dataCount", "usualDataCount", "usualDataRate"]

_BUCKET_SOURCE = [MAX, MIN, MEAN, STDDEV, COUNT, USUAL, RATE]
_DEVICE_SOURCE = [DEVICES, COUNT, USUAL, RATE]

NO_DATA_JSON = '{"status":"%s"}' % NO_DATA_STATUS


def _report(stats: DataFrame, key: Column, sources, body) -> DataFrame:
    # One list of whole rows, sorted once by key; the maps are read off it.
    row = F.struct(key.cast("string").alias("k"), *[F.col(c) for c in sources])
    agg = stats.agg(F.array_sort(F.collect_list(row)).alias("_rows"))

    def json_map(name: str) -> Column:
        return F.to_json(F.map_from_arrays(F.transform("_rows", lambda r: r["k"]), F.transform("_rows", lambda r: r[name])))

    ok = F.concat(F.lit('{"status":"%s","data":' % OK_STATUS), body([json_map(c) for c in sources]), F.lit("}"))
    return agg.select(F.when(F.size("_rows") == 0, F.lit(NO_DATA_JSON)).otherwise(ok).alias("value"))


def bucket_report(stats: DataFrame) -> DataFrame:
    """``{"status":"success","data":[max, min, mean, stdev, count,
    usualCount, usualRate]}``, each a map bucket -> number; ``{"status":"No
    Matching Data"}`` without rows (O18)."""
    return _report(
        stats, F.col(BUCKET), _BUCKET_SOURCE,
        lambda parts: F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]")),
    )


def device_report(stats: DataFrame) -> DataFrame:
    """``{"status":"success","data":{"deviceCount":{..},"dataCount":{..},
    "usualDataCount":{..},"usualDataRate":{..}}}`` keyed by device type (O19)."""
    def body(parts):
        pieces = []
        for i, (name, p) in enumerate(zip(DEVICE_METRICS, parts)):
            pieces += [F.lit(("{" if i == 0 else ",") + '"%s":' % name), p]
        return F.concat(*pieces, F.lit("}"))

    return _report(stats, F.col(TYPE), _DEVICE_SOURCE, body)


def bucket_report_rows(report: DataFrame, keep=()) -> DataFrame:
    """A bucket report parsed back to (status, metric, bucket, value) rows, after the
    columns in ``keep`` (a record's topic, say)."""
    keep = list(keep)
    p = F.from_json("value", "status string, data array<map<string,double>>")
    x = report.select(*keep, p.alias("_r")).select(*keep, "_r.status", F.posexplode_outer("_r.data").alias("i", "m"))
    names = F.array(*[F.lit(n) for n in BUCKET_METRICS])
    x = x.select(*keep, "status", F.element_at(names, F.col("i") + 1).alias("metric"), F.explode_outer("m").alias("_k", "_v"))
    return x.select(*keep, "status", "metric", F.col("_k").alias("bucket"), F.col("_v").alias("value"))


def device_report_rows(report: DataFrame, keep=()) -> DataFrame:
    """A device report parsed back to (status, metric, device_type, value) rows, after
    the columns in ``keep``."""
    keep = list(keep)
    p = F.from_json("value", "status string, data map<string,map<string,double>>")
    x = report.select(*keep, p.alias("_r")).select(*keep, "_r.status", F.explode_outer("_r.data").alias("metric", "m"))
    x = x.select(*keep, "status", "metric", F.explode_outer("m").alias("_k", "_v"))
    return x.select(*keep, "status", "metric", F.col("_k").alias(TYPE), F.col("_v").alias("value"))
