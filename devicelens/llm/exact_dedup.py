"""Exact dedup of texts (operator 3): two passes over digests with a Bloom filter.

The text is read once, for a table of digests. Pass 1 counts, for each of two hash
functions, the digests that fall on every bit of a Bloom filter; bits that two or
more rows hit form the filter of possibly repeated hashes (a table of 4 KB bitmaps).
Pass 2 probes it: a row whose two bits are not both set has no equal and passes
straight through; only the others shuffle, and are grouped by the whole SHA-256.
DataFrame and SQL functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_group_facts, stored

SPACES = r"[\x20\x09-\x0D]+"
BITS_PER_ROW = 16
#: Largest filter (both functions, bytes) that is broadcast; a larger one is joined by a shuffle.
MAX_BROADCAST_BYTES = 32 << 20


def normal_text(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _bit(digest: str, seed: int, bits: int) -> Column:
    """Bit of the filter's half ``seed`` that a digest falls on."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(digest)), F.lit(bits)) + F.lit(seed * bits)


def _probe(rows: DataFrame, bitmaps: DataFrame, bit: str, found: str) -> DataFrame:
    """Add boolean ``found``: is bit number ``bit`` set in the filter?"""
    maps = bitmaps.select(F.col("bucket").alias("_bucket"), "bitmap")
    at = F.expr(f"bitmap_bit_position({bit})")
    byte = F.conv(F.hex(F.expr(f"substring(bitmap, cast(bitmap_bit_position({bit}) div 8 as int) + 1, 1)")), 16, 10)
    hit = F.expr("shiftright(cast({} as int), cast({} % 8 as int)) & 1 = 1".format("_byte", "_at"))
    return (rows.join(maps, F.expr(f"bitmap_bucket_number({bit})") == F.col("_bucket"), "left")
            .withColumns({"_byte": byte, "_at": at})
            .withColumn(found, F.coalesce(hit, F.lit(False)))
            .drop("_byte", "_at", "_bucket", "bitmap"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after each run of ASCII white space became one
    space; NULL counts as empty. The smallest id of a group stays (NULL ids sort
    last); of rows that repeat id and text exactly one stays. Other columns are not
    read. An empty table gives an empty result."""
    digests = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.unhex(F.sha2(normal_text(F.col(text_col)), 256)).alias("sha"),
            F.monotonically_increasing_id().alias("row"),
        ), "exact-digests")
    total = digests.count()
    bits = 1 << max(15, math.ceil(math.log2(max(1, total) * BITS_PER_ROW)))
    positions = digests.select(F.explode(F.array(_bit("sha", 0, bits), _bit("sha", 1, bits))).alias("bit"))
    twice = positions.groupBy("bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bitmaps = stored(
        twice.groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bitmap")), "exact-filter")
    if bits // 4 <= MAX_BROADCAST_BYTES:
        bitmaps = F.broadcast(bitmaps)
    probed = _probe(_probe(digests.withColumns({"_b0": _bit("sha", 0, bits), "_b1": _bit("sha", 1, bits)}),
                           bitmaps, "_b0", "_f0"), bitmaps, "_b1", "_f1")
    probed = probed.select("id", "sha", "row", (F.col("_f0") & F.col("_f1")).alias("maybe"))
    single = probed.where("not maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    maybe = probed.where("maybe").drop("maybe")
    first = F.min(F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("id"), F.col("row").alias("row")))
    groups = stored(maybe.groupBy("sha").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size")),
                    "exact-groups")
    grouped = join_group_facts(maybe, groups, "sha", "group_size", total).select(
        "id", F.col("first.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "sha")
    return single.unionByName(grouped).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
