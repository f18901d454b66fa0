"""Small helpers the operators share: scratch tables, hot-group joins, storage."""

from __future__ import annotations

import contextlib
import functools
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: A group is hot when it holds more than 1/HOT_SHARE of the rows, so there are
#: fewer than HOT_SHARE hot groups, whatever the data: the bound of their broadcast.
HOT_SHARE = 1024


#: Spark's limit on the bytes of a batch that goes to Python, and what operators with wide rows set it to.
#: A batch is held by the executor and, with what is made of it, by the Python worker.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SMALL_BATCH = 4 << 20


def in_small_batches(function):
    """The jobs that ``function`` (of a DataFrame) runs send Python SMALL_BATCH bytes at once at the
    most; what it returns must not call Python any more."""
    @functools.wraps(function)
    def run(df: DataFrame, *args, **kwargs):
        conf = df.sparkSession.conf
        before = conf.get(ARROW_BYTES, None)
        if before is not None and 0 < int(before) <= SMALL_BATCH:
            return function(df, *args, **kwargs)
        conf.set(ARROW_BYTES, str(SMALL_BATCH))
        try:
            return function(df, *args, **kwargs)
        finally:
            conf.unset(ARROW_BYTES) if before is None else conf.set(ARROW_BYTES, before)
    return run


_recorders: list[list[str]] = []


@contextlib.contextmanager
def recorded(paths: list[str]):
    """Paths that :func:`stored` writes meanwhile are appended to ``paths``."""
    _recorders.append(paths)
    try:
        yield paths
    finally:
        _recorders.remove(paths)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back:
    computed once, lineage cut, safe against lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    for paths in _recorders:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that nothing reads any more, and forget their names."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        p = jvm.org.apache.hadoop.fs.Path(paths.pop())
        p.getFileSystem(conf).delete(p, True)


def join_group_facts(rows: DataFrame, facts: DataFrame, key: str, size_col: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one ``facts`` row per ``key``; no task gets a
    whole hot group.

    Facts of hot groups (``size_col`` above ``total / HOT_SHARE``: fewer than
    HOT_SHARE rows) are broadcast; the rest meet by an ordinary shuffle, in which
    no key holds more than that share."""
    limit = max(1, total // HOT_SHARE)
    hot = F.broadcast(facts.where(F.col(size_col) > limit))
    cold = facts.where(F.col(size_col) <= limit)
    return (rows.join(hot, key)
            .unionByName(rows.join(hot.select(key), key, "left_anti").join(cold.hint("merge"), key)))


def join_shared(rows: DataFrame, facts: DataFrame, key: str, size_col: str, total: int) -> DataFrame:
    """As :func:`join_group_facts`, for keys that are numbers or texts: those of the hot groups
    (fewer than HOT_SHARE) are fetched, so both parts are a filter and a join, and there is
    one part only where no group is hot."""
    limit = max(1, total // HOT_SHARE)
    hot = [r[0] for r in facts.where(F.col(size_col) > limit).select(key).collect()]
    if not hot:
        return rows.join(facts.hint("merge"), key)
    is_hot = F.col(key).isin(hot)
    return (rows.where(is_hot).join(F.broadcast(facts.where(is_hot)), key)
            .unionByName(rows.where(~is_hot).join(facts.where(~is_hot).hint("merge"), key)))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Driver: write a small file to any store Hadoop knows."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(data)
    finally:
        out.close()


def open_store(path: str):
    """Executor: (pyarrow file system, path in it) of a shared folder's URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), os.path.abspath(path)
    return fs.FileSystem.from_uri(path)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, as ``--py-files`` would,
    unless PYTHONPATH already has it."""
    import shutil
    import tempfile
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    if app in _shipped or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="devicelens-code-"), "devicelens")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, Path(__file__).resolve().parents[1].name))
    _shipped.add(app)


def join_salted(rows: DataFrame, facts: DataFrame, key: str, spread: str, sizes: DataFrame | None = None) -> DataFrame:
    """Inner join of ``rows`` with large ``facts`` (few per key), hot keys in pieces.

    A key with more than 1/HOT_SHARE of the rows (counted in ``sizes``, by default
    ``rows``) is cut by the hash of ``spread`` into pieces of about that share, and
    its facts are repeated for each piece; the piece counts of those fewer than
    HOT_SHARE keys are what is broadcast."""
    counts = (rows if sizes is None else sizes).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    counts = stored(counts, "salt-counts")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    limit = max(1, total // HOT_SHARE)
    hot = F.broadcast(counts.where(F.col("_n") > limit).select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_pieces")))
    salted = rows.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_pieces").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(spread), F.col("_pieces")).cast("int")))
    copies = facts.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
    return salted.drop("_pieces").join(copies.drop("_pieces"), [key, "_salt"]).drop("_salt")
