"""Places of rows in a global order, without gathering them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored

_PART_BITS = 33  # monotonically_increasing_id: the partition's number above, the row's below


def numbered(rows: DataFrame, order: list[Column], column: str, name: str) -> DataFrame:
    """``rows`` with ``column``: their place, from 1, in the given order, as a written table.

    Rows are dealt by ranges of the order and sorted in each; places follow from the sizes
    of the ranges, of which the driver gets one number each. Ties in the order are places
    apart in no certain order, so end it with a column that tells rows apart."""
    at = F.col("_at")
    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned(at, _PART_BITS).cast("int")
    sizes = {r.part: r.n for r in dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for k in range(max(sizes, default=0) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    place = F.get(F.array(*[F.lit(b).cast("long") for b in before]), part) + at.bitwiseAND((1 << _PART_BITS) - 1) + 1
    return dealt.withColumn(column, place).drop("_at")
