"""Comma-text readings (O5): ``tenant,type,device,value,time_ms`` per line,
no header, no quoting.

Like a Scala ``split(",")``, trailing empty fields are dropped, so
``a,b,c,1.0,5,,`` is a valid line; any other field count is an error.  The
CSV reader is not used: with column pruning it skips the checks of unread
columns, and it turns empty strings into NULL.  Here the check is a filter,
which no projection can prune.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import ms_to_ts
from ..schema import DEVICE, HOUR_MS, READING_FIELDS, READINGS, TENANT, TIME_MS, TS, TYPE, VALUE
from .paths import range_glob

_INT = r"^[+-]?[0-9]+$"


_PARTS = "_parts"


def _split(df: DataFrame, line: str, keep=()) -> DataFrame:
    """(line, fields), each line split once: the optimizer cannot copy a split
    that stands behind an explode into every expression that reads it."""
    fields = F.split(F.rtrim(F.col(line), F.lit(",")), ",", -1)
    return df.select(*keep, F.col(line).alias("_line"), F.explode(F.array(fields)).alias(_PARTS))


def _int(text: Column) -> Column:
    """Number of digits with an optional sign, else NULL.  Only a text that is not
    its number's own (a plus sign, leading zeros, blanks) pays for the pattern."""
    n = text.try_cast("bigint")
    return F.when(n.cast("string") == text, n).when(text.rlike(_INT), n)


def _typed(parts: Column):
    p = [F.get(parts, F.lit(i)) for i in range(5)]
    tenant, val, ms = _int(p[0]), p[3].try_cast("double"), _int(p[4])
    ok = (F.size(parts) == F.lit(5)) & tenant.isNotNull() & val.isNotNull() & ms.isNotNull()
    return p, tenant, val, ms, F.coalesce(ok, F.lit(False))


def parse_reading_lines(df: DataFrame, line_col: str = "value", mode: str = "FAILFAST", keep=()):
    """Lines -> readings.  ``FAILFAST`` (default, the reference's behaviour)
    raises on the first bad line; ``PERMISSIVE`` returns ``(readings,
    bad_lines)``.  Columns in ``keep`` are carried along in both."""
    x = _split(df, line_col, keep)
    p, tenant, val, ms, ok = _typed(F.col(_PARTS))
    cols = [
        tenant.alias(TENANT), p[1].alias(TYPE), p[2].alias(DEVICE), val.alias(VALUE), ms.alias(TIME_MS),
        *keep,
    ]
    if mode.upper() == "FAILFAST":
        checked = x.where(
            F.when(ok, F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("malformed reading line: "), F.col("_line")))
            )
        )
        out = checked.select(*cols)
        return out.withColumn(TS, ms_to_ts(TIME_MS))
    if mode.upper() == "PERMISSIVE":
        good = x.where(ok).select(*cols)
        bad = x.where(~ok).select(F.col("_line").alias("line"), *keep)
        return good.withColumn(TS, ms_to_ts(TIME_MS)), bad
    raise ValueError("mode must be FAILFAST or PERMISSIVE")


def read_reading_lines(spark: SparkSession, path: str, mode: str = "FAILFAST"):
    """Read comma-text readings from files (globs allowed)."""
    return parse_reading_lines(spark.read.text(path), "value", mode)


def format_reading_lines(df: DataFrame) -> DataFrame:
    """Readings -> one ``value`` text line each (the stream job's text form)."""
    return df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in READING_FIELDS]).alias("value"))


# Fixed value: folder name prefix of the reference's hourly text output.
TEXT_DIR_PREFIX = "device-data-"


def read_text_hours(spark: SparkSession, root: str, start_ms: int, end_ms: int, pad_hours: int | None = None,
                    mode: str = "FAILFAST"):
    """Readings of ``[start, end]`` from the reference's layout: comma text in
    one folder ``device-data-<window end ms>`` per hourly window.

    Folders are named by arrival, so a reading of the range can be in any of
    them: by default all are read (convert the layout once to the stored table,
    which prunes by event day).  A caller who knows how late readings arrive at
    most may give ``pad_hours``: then only folders whose window end lies in
    ``[start - pad, end + pad + 1 h]`` are read, named by one glob of prefix
    alternatives.  The exact time filter is the analysis' own."""
    if pad_hours is None:
        names = "*"
    else:
        names = range_glob(max(int(start_ms) - int(pad_hours) * HOUR_MS, 0), int(end_ms) + (int(pad_hours) + 1) * HOUR_MS)
    if names is None:
        return _empty(spark, mode)
    # Folders, not files: Spark lists them and skips _SUCCESS and checksum files.
    glob = f"{root.rstrip('/')}/{TEXT_DIR_PREFIX}{names}"
    try:
        return read_reading_lines(spark, glob, mode)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return _empty(spark, mode)


def _empty(spark: SparkSession, mode: str):
    out = spark.createDataFrame([], READINGS).withColumn(TS, ms_to_ts(TIME_MS))
    if mode.upper() == "PERMISSIVE":
        return out, spark.createDataFrame([], "line string")
    return out
