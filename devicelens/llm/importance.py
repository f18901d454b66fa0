"""Resampling towards a target distribution by bit-sliced importance weights (operator 11).

Features are all runs of one to three words; a feature's bucket is its CRC-32 modulo
BUCKETS. A bucket's gain tells how much likelier the target is to show it than the
corpus. A document's weight is the sum of gains over its features, and it is computed
without a multiplication: its counts are sliced into planes, one bit of every bucket
each, the gains into signed planes, and each pair of planes contributes the number of
bits that both have, times a power of two. Scores add Gumbel noise to the weights, so the
highest ones are a draw without replacement.

A CRC of joined words follows from the words' own (it is linear: shifting by the bytes
that follow is one of 32 table operators), so every word is hashed once. Long texts are
read in pieces that overlap by two words.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_partitions, stored

BUCKETS = 10_000
RUN = 3                      # words of the longest feature
PIECE = 4 << 20              # bytes of text hashed at once
GROUP_TEXTS, GROUP_BYTES = 128, 1 << 20   # texts whose counts are held at once
STRIDE = -(-BUCKETS // 64) * 64   # cells of a text: its planes are whole 64-bit words
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
INSIDE = np.array([48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)])
OUTSIDE = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
LONG_WORD = 64               # words up to this length are hashed together, byte by byte


# ------------------------------------------------------------------ CRC-32 of many words

@functools.cache
def crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


@functools.cache
def _operator(k: int) -> np.ndarray:
    """[4, 256]: a CRC's change by 2**k zero bytes, by its four bytes."""
    if k == 0:
        images = crc_table()[(np.uint32(1) << np.arange(32, dtype=np.uint32)) & 255] ^ (np.uint32(1) << np.arange(32, dtype=np.uint32) >> np.uint32(8))
    else:
        half = _operator(k - 1)
        images = _apply(half, _apply(half, np.uint32(1) << np.arange(32, dtype=np.uint32)))
    out = np.zeros((4, 256), np.uint32)
    bits = np.arange(256)
    for j in range(4):
        for b in range(8):
            out[j] ^= np.where(bits >> b & 1, images[8 * j + b], 0).astype(np.uint32)
    return out


def _apply(op: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return op[0][crc & 255] ^ op[1][crc >> 8 & 255] ^ op[2][crc >> 16 & 255] ^ op[3][crc >> 24]


def shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRCs as they count in strings that go on for ``n`` bytes."""
    crc, k = crc.copy(), 0
    while (left := n >> k).any():
        at = np.flatnonzero(left & 1)
        crc[at] = _apply(_operator(k), crc[at])
        k += 1
    return crc


def word_crcs(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    size, table = ends - starts, crc_table()
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    live = np.flatnonzero(size <= LONG_WORD)
    for k in range(LONG_WORD):
        live = live[size[live] > k]
        if not len(live):
            break
        c = crc[live]
        crc[live] = table[(c ^ flat[starts[live] + k]) & 255] ^ (c >> 8)
    crc = ~crc
    for i in np.flatnonzero(size > LONG_WORD):
        crc[i] = zlib.crc32(flat[starts[i]:ends[i]].tobytes())
    return crc


# ------------------------------------------------------------------ features of texts

def _words(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], INSIDE[flat], [False]]).view(np.int8)))
    return edge[::2], edge[1::2]


def buckets_of(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, known: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owners, buckets) of all runs of words of one owner that end after the first ``known`` words."""
    crc, size = word_crcs(flat, starts, ends), ends - starts
    joined = shifted(np.full(len(crc), zlib.crc32(b" "), np.uint32), size) ^ crc  # of a space and the word
    run = crc
    for n in range(RUN):
        if n:
            same = owner[:-n] == owner[n:] if len(owner) > n else np.zeros(0, bool)
            run = shifted(run[:len(same)], size[n:] + 1) ^ joined[n:]
        else:
            same = np.ones(len(owner), bool)
        same[:max(0, known - n)] = False
        yield owner[:len(same)][same], (run[same] % np.uint32(BUCKETS)).astype(np.int64)


def pieces(text: bytes, limit: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(bytes, word starts, word ends, words known from the piece before) of a lower-cased
    text, cut between words; each piece begins with the last words of the one before."""
    at, known = 0, b""
    while at < len(text):
        cut = OUTSIDE.search(text, min(len(text), at + limit))
        end = cut.start() if cut else len(text)
        flat = np.frombuffer(known + text[at:end], np.uint8)
        starts, ends = _words(flat)
        yield flat, starts, ends, len(known.split())
        known = b"".join(flat[a:b].tobytes() + b" " for a, b in zip(starts[-(RUN - 1):], ends[-(RUN - 1):]))
        at = end


def groups(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts) of groups that are counted together; a long text is alone."""
    first, got, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t or b""
        if got and (len(got) == GROUP_TEXTS or size + len(t) > GROUP_BYTES):
            yield first, got
            first, got, size = i, [], 0
        got.append(t.translate(LOWER))
        size += len(t)
    if got:
        yield first, got


def hashed(texts: list[bytes]) -> Iterator[tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """(owners of words, (owners, buckets) of features) of the texts of one group, in parts."""
    if len(texts) == 1:
        for flat, starts, ends, known in pieces(texts[0]):
            owner = np.zeros(len(starts), np.int64)
            yield owner[known:], buckets_of(flat, starts, ends, owner, known)
    else:
        flat = np.frombuffer(b" ".join(texts), np.uint8)
        starts, ends = _words(flat)
        owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, "right")
        yield owner, buckets_of(flat, starts, ends, owner)


def counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """([text, bucket] counts of features in STRIDE cells a text, words of each text) of one group."""
    counts, words = np.zeros(len(texts) * STRIDE, np.int64), np.zeros(len(texts), np.int64)
    for owners, features in hashed(texts):
        words += np.bincount(owners, minlength=len(texts))
        for who, bucket in features:
            counts += np.bincount(who * STRIDE + bucket, minlength=len(counts))
    return counts.reshape(len(texts), STRIDE), words


# ------------------------------------------------------------------ bit-sliced sums

def planes(values: np.ndarray) -> Iterator[np.ndarray]:
    """Non-negative numbers [row, cell] by bit, the lowest first: [row, 64-bit word] each."""
    flat = values.reshape(-1)
    at = np.flatnonzero(flat)
    held = flat[at]
    for j in range(int(held.max(initial=0)).bit_length()):
        bits = np.zeros(len(flat), np.uint8)
        bits[at[held >> j & 1 == 1]] = 1
        yield np.packbits(bits).view(np.uint64).reshape(len(values), -1)


def sliced(gains: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(sign, bit, plane) of the gains of all buckets."""
    wide = np.zeros((1, STRIDE), np.int64)
    wide[0, :len(gains)] = gains
    return [(sign, k, plane[0]) for sign in (1, -1) for k, plane in enumerate(planes(np.maximum(sign * wide, 0)))]


def weights(counts: np.ndarray, gains: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """Sum over buckets of count * gain for every row of ``counts``, by planes."""
    out = np.zeros(len(counts), np.int64)
    for j, plane in enumerate(planes(counts)):
        rows = np.flatnonzero(plane.any(1))
        plane = plane[rows]
        for sign, k, gain in gains:
            out[rows] += sign * (np.bitwise_count(plane & gain).sum(1, dtype=np.int64) << (j + k))
    return out


# ------------------------------------------------------------------ Spark

def _binary(batch, name: str) -> list:
    import pyarrow as pa

    return batch[name].cast(pa.binary()).to_pylist()


def _corpus_counts(batches: Iterable) -> Iterator:
    """One row a bucket that the task has seen."""
    import pyarrow as pa

    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, texts in groups(_binary(batch, "text")):
            for _, features in hashed(texts):
                for _, bucket in features:
                    total += np.bincount(bucket, minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])


def bucket_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(``bucket``, ``n``): features of all texts by bucket; empty buckets have no row."""
    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(_corpus_counts, "bucket int, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of every bucket from both tables of counts (BUCKETS rows each at most)."""
    s, t = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for into, counts in ((s, corpus), (t, target)):
        for row in counts.collect():
            into[row.bucket] = row.n
    whole_s, whole_t = int(s.sum()), int(t.sum())
    return np.array([math.floor(1000 * math.log(float(b + 1) * float(whole_s + BUCKETS) / (float(a + 1) * float(whole_t + BUCKETS))))
                     for a, b in zip(s.tolist(), t.tolist())], np.int64)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a hash of ``<seed>:<key>``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def importance_weights(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       keep: tuple = ()) -> DataFrame:
    """id, the columns ``keep``, ``n_words``, ``n_features``, ``weight`` of every row of ``docs``.

    Words are runs of digits, letters a-z (after lower-casing A-Z) and characters beyond
    ASCII; NULL and wordless texts have no features and weight 0. Rows that repeat an id are
    weighed one by one, and count in the corpus as often as they stand there. An empty
    ``target`` or an empty ``docs`` counts no features; other columns are not read."""
    gains = sliced(bucket_gains(bucket_counts(docs, text_col), bucket_counts(target)))

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            words, features, sums = [], [], []
            for _, texts in groups(_binary(batch, "text")):
                counts, n = counted(texts)
                words.append(n)
                features.append(counts.sum(1))
                sums.append(weights(counts, gains))
            if words:
                yield pa.RecordBatch.from_arrays([batch["of"], *(pa.array(np.concatenate(x)) for x in (words, features, sums))],
                                                 ["of", "n_words", "n_features", "weight"])

    rows = docs.select(F.struct(id_col, *keep).alias("of"), F.col(text_col).alias("text"))
    out = T.StructType([rows.schema["of"], *T.StructType.fromDDL("n_words long, n_features long, weight long")])
    return rows.mapInArrow(run, out).select("of.*", "n_words", "n_features", "weight")


def importance_ranks(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
                     id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """:func:`importance_weights` with ``score`` and ``rank``: of the N rows with at least
    ``least_words`` words, the floor(``percent`` * N / 100) highest scores have ranks 1, 2, ...

    Ties go to the smaller id (NULL last; its noise is that of an empty id), then to the row
    with fewer features; rows alike in all that are interchangeable. The others have rank NULL."""
    scored = importance_weights(docs, target, id_col, text_col, keep).withColumn("score", F.col("weight") + noise(F.col(id_col), seed))
    scored = stored(scored.withColumn("_row", F.monotonically_increasing_id()), "importance-scores")
    enough = scored.where(F.col("n_words") >= least_words)
    order = [F.desc("score"), F.asc_nulls_last(id_col), F.asc("n_features"), F.asc("_row")]
    dealt = enough.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    # partition number and place in it: ranks need only the partitions' sizes
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "importance-order")
    part = F.shiftrightunsigned("_at", 33).cast("int")
    sizes = {r.part: r.n for r in dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn, before, total = percent * sum(sizes.values()) // 100, [], 0
    for k in range(max(sizes, default=0) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    place = F.get(F.array(*[F.lit(b).cast("long") for b in before]), part) + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    ranked = dealt.withColumn("rank", F.when(place <= drawn, place)).drop("_at")
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop("_row")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text`` and others) that are drawn, with all columns as they are.

    A row is named by a number of its own, so rows that repeat id and text are drawn one by one."""
    rows = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("of"), F.monotonically_increasing_id().alias("at")),
                  "importance-rows")
    ranks = importance_ranks(rows.select("at", "of.doc_id", "of.text"), target, percent, least_words, seed, keep=("at",))
    return rows.join(ranks.where("rank is not null").select("at"), "at", "left_semi").select("of.*")


def resampling_digests(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` of every row of ``docs``."""
    return importance_ranks(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
