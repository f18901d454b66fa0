"""Small driver-side files on any store Hadoop knows, written all at once or not at all."""

from __future__ import annotations

import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Files of a folder with their sizes and times, as one short text."""
    p, fs = _path(spark, folder)
    files = sorted((s.getPath().getName(), int(s.getLen()), int(s.getModificationTime())) for s in fs.listStatus(p))
    return hashlib.sha256(repr(files).encode()).hexdigest()[:24]


def modified_ms(spark: SparkSession, path: str) -> int:
    p, fs = _path(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a file, or None if there is none."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False if it exists already (then nothing is changed).

    The text is written under another name and moved, so no reader sees a part of it, and of
    two writers one wins: the move refuses a name that is taken."""
    sc = spark.sparkContext
    jvm, (p, fs) = sc._jvm, _path(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), sc._jsc.hadoopConfiguration())
    try:
        if fs.exists(p):
            return False
        context.rename(part, p, sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
        return False
    finally:
        if fs.exists(part):
            fs.delete(part, False)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder; nothing happens if there is none."""
    p, fs = _path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename a file or folder; the new name must be free."""
    p, fs = _path(spark, new)
    if fs.exists(p) or not fs.rename(_path(spark, old)[0], p):
        raise OSError(f"cannot move {old} to {new}")
