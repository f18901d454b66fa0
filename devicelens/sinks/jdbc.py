"""Recent-analysis rows to a relational table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DATE


def recent_rows(df: DataFrame, end_ms: int) -> DataFrame:
    """Rows as stored: every double NaN -> 0.0, plus ``date`` = the UTC date
    of ``end_ms``."""
    cols = [
        F.nanvl(F.col(f.name), F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols, F.to_date(F.timestamp_millis(F.lit(int(end_ms)))).alias(DATE))


def append_recent(df: DataFrame, url: str, table: str, end_ms: int, properties: dict | None = None,
                  batch_size: int = 1000, connections: int = 8) -> None:
    """Append :func:`recent_rows` through JDBC, written by the executors in
    batches over at most ``connections`` connections (Spark coalesces to
    ``numPartitions``; the rows are tenants x types, so few).  A failing
    batch fails the job (the reference printed and skipped the row).
    Credentials come from ``properties``, never code."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    props.setdefault("numPartitions", str(connections))
    recent_rows(df, end_ms).write.jdbc(url=url, table=table, mode="append", properties=props)
