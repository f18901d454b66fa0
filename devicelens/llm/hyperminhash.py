"""Near-duplicate detection with HyperMinHash (operator 1).

A text's word shingles are hashed to 64 bits. The top bits of a hash choose a
bucket, the rest competes for the bucket's minimum, of which the sketch keeps the
number of leading zeros and a few mantissa bits (16 bits a register). Bands of
compressed registers propose candidates, a collision-corrected Jaccard estimate on a
finer sketch thins them out, and every link is confirmed on the full shingle sets.

Equal shingle sets are first collapsed to one class each. A band bucket is then
searched in two rounds: first each member against the bucket's least member (a scan of
sorted rows), then, where several components still meet, the pairs that cross
components, in tiles that Spark deals out: the members of the largest component meet the
others only, and a pair is tested in its first common band only, first by the bands' own
registers. What is left of a tile goes on as a block: a row for each of its members, with the
candidates as bits. Its finer registers, then its full sets are joined to the members, and
of the links found only a spanning forest is written. So a group of any size is neither
gathered nor written out as pairs.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, in_small_batches, join_group_facts, join_salted, join_shared, shuffle_partitions, stored
from .components import components

COARSE, FINE = 7, 10         # bits of bucket number: 128 registers for bands, 1024 for estimates
MANTISSA = 10                # mantissa bits of a register
BAND = 4                     # registers of a band: 64 bits
BANDS = (1 << COARSE) // BAND
DEVIATIONS = 4.75            # a true link is estimated too low once in a million
TILE = 512                   # members of a bucket that one tile compares with another
HOT_PIECES = 64              # pieces of a hot bucket in round 1
BLOCK_SHINGLES = 1 << 20     # shingles on a side of a block, and one text
BATCH_BYTES = 1 << 19        # text hashed at once; a longer one is hashed in pieces

SPACE = re.compile(rb"[\x20\x09-\x0D]")
WORD_SPACE = np.zeros(256, bool)
WORD_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = 0x9E3779B97F4A7C15      # odd: has an inverse modulo 2**64

SIGNATURE = "doc_id long, body long, n_shingles long, digest binary, bands binary, registers binary"


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(p):
        out = np.full(n, p, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(np.uint64(_P)), run(np.uint64(pow(_P, -1, 1 << 64)))


def word_hashes(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the words of ``data``, their first positions); ASCII is lower-cased."""
    flat = np.frombuffer(data.translate(LOWER), np.uint8)
    inside = ~WORD_SPACE[flat]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(width)
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(_byte_values()[flat] * up[:len(flat)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h ^ (ends - starts).astype(np.uint64)), starts


def _long_set(text: bytes, words: int) -> np.ndarray | None:
    """Shingles of a long text, hashed in pieces that repeat the last words of the one
    before; None if it has fewer words than a shingle."""
    found, at, known, n = [], 0, b"", 0
    while at < len(text):
        cut = SPACE.search(text, min(len(text), at + BATCH_BYTES))
        end = cut.start() if cut else len(text)
        piece = known + text[at:end]
        last = piece.rsplit(None, words - 1)  # the rest, and the last words but one shingle's first
        n = max(n, len(last))
        if len(last) == words:
            found.append(next(_short_sets([piece], words)))
        known = b"".join(w + b" " for w in (last[-(words - 1):] if words > 1 else []))
        at = end
    return np.unique(np.concatenate(found)) if n >= words else None


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text. Fewer words than a shingle make
    one shingle of them all; none make an empty set."""
    if len(texts) == 1 and len(texts[0]) > 2 * BATCH_BYTES and (whole := _long_set(texts[0], words)) is not None:
        yield whole
    else:
        yield from _short_sets(texts, words)


def _short_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    joined = b"\n".join(texts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    width = 1 << max(16, (len(joined) + 1).bit_length())
    h, starts = word_hashes(joined, width) if joined else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    cut = np.concatenate([[0], np.searchsorted(starts, ends)])
    factors = [mix(np.array([k + 11], np.uint64) * np.uint64(_P))[0] | np.uint64(1) for k in range(words)]
    rolled = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for k in range(words):
        rolled += h[k:k + len(rolled)] * factors[k]
    rolled = mix(rolled)
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a >= words:
            yield np.unique(rolled[a:b - words + 1])
        elif b > a:
            yield mix((h[a:b] * np.array(factors[:b - a])).sum(keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def registers(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Compressed minimum of every bucket of sorted ``hashes``: 1 + (leading zeros,
    mantissa), 0 for an empty bucket."""
    n, rest = 1 << bits, 64 - bits
    first = np.searchsorted(hashes, np.arange(n, dtype=np.uint64) << np.uint64(rest))
    full = first < np.append(first[1:], len(hashes))
    low = hashes[first[full]] & np.uint64((1 << rest) - 1)
    length = np.zeros(len(low), np.int64)  # bit length of the minimum
    for step in (32, 16, 8, 4, 2, 1):
        more = (low >> (length + step).astype(np.uint64)) > 0
        length[more] += step
    length += low > 0
    mantissa = np.where(length > MANTISSA, low >> np.maximum(length - 1 - MANTISSA, 0).astype(np.uint64),
                        low << np.maximum(MANTISSA + 1 - length, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    out = np.zeros(n, np.uint16)
    out[full] = 1 + ((rest - length).astype(np.uint64) << np.uint64(MANTISSA)) + mantissa
    return out


@functools.cache
def _collisions(bits: int) -> np.ndarray:
    """[i, j]: chance that a bucket's registers agree for unrelated sets of 2**i and
    2**j members: both minima fall between the same powers of two (sum over leading
    zeros) and share the mantissa."""
    k = np.arange(0, 58)
    load = 2.0 ** (np.arange(0, 40) - bits)
    p = np.exp(-load[:, None] * 2.0 ** -(k + 1)) - np.exp(-load[:, None] * 2.0 ** -k)
    occupied = 1 - np.exp(-load[:, None] - load[None, :])
    return 2.0 ** -MANTISSA * (p @ p.T) / occupied


def collision_rate(na, nb, bits: int = FINE) -> np.ndarray:
    """Expected share of occupied buckets that agree by chance."""
    at = [np.log2(np.maximum(np.asarray(n, float), 1)).round().astype(int) for n in (na, nb)]
    return _collisions(bits)[at[0], at[1]]


def estimate(a: np.ndarray, b: np.ndarray, na, nb, bits: int = FINE) -> np.ndarray:
    """Collision-corrected Jaccard estimate of register rows (last axis)."""
    occupied = ((a | b) != 0).sum(-1)
    agree = ((a == b) & (a != 0)).sum(-1)
    raw = agree / np.maximum(occupied, 1)
    c = collision_rate(na, nb, bits)
    return np.maximum(0.0, (raw - c) / (1 - c))


def least_estimate(na, nb, percent: int, bits: int = FINE) -> np.ndarray:
    """Estimate from which a pair of sets of these sizes goes to confirmation.

    The occupied buckets show one member each of the union, a sample without
    replacement, so a pair at the threshold is estimated DEVIATIONS standard
    deviations lower at the most; small sets may lose a few members besides."""
    t, buckets = percent / 100, 1 << bits
    union = (np.asarray(na, float) + nb) / (1 + t)
    shown = buckets * -np.expm1(-union / buckets)
    deviation = np.sqrt(t * (1 - t) / shown * (union - shown) / np.maximum(union - 1, 1))
    return t - np.maximum(DEVIATIONS * deviation + 1 / shown, 3 / shown)


def _batches(column, ids, limit: int = BATCH_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Groups of (ids, texts as bytes) of about ``limit`` bytes; one long text is a group."""
    got_ids, got, size = [], [], 0
    for i, t in zip(ids, column):
        t = t or b""
        if got and size + len(t) > limit:
            yield got_ids, got
            got_ids, got, size = [], [], 0
        got_ids.append(i)
        got.append(t)
        size += len(t)
    if got:
        yield got_ids, got


def _signatures(words: int):
    def run(batches: Iterable) -> Iterator:
        import hashlib

        import pyarrow as pa

        for batch in batches:
            texts = batch["text"].cast(pa.binary()).to_pylist()
            for keys, part in _batches(texts, zip(batch["doc_id"].to_pylist(), batch["body"].to_pylist())):
                ids, bodies = zip(*keys)
                n, digest, bands, regs = [], [], [], []
                for s in shingle_sets(part, words):
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    bands.append(registers(s, COARSE).tobytes())
                    regs.append(registers(s, FINE).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(bodies, pa.int64()), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                     pa.array(bands, pa.binary()), pa.array(regs, pa.binary())],
                    ["doc_id", "body", "n_shingles", "digest", "bands", "registers"])
    return run


def _band_rows(batches: Iterable) -> Iterator:
    """(bucket, band, doc, component) of every band with a full register."""
    import pyarrow as pa

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, component = np.asarray(batch["doc_id"]), np.asarray(batch["component"])
        keys = np.frombuffer(b"".join(batch["bands"].to_pylist()), np.uint64).reshape(-1, BANDS)
        row, band = np.nonzero(keys)
        bucket = mix(keys[row, band] ^ mix((band + 1).astype(np.uint64) * np.uint64(_P)))
        yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(band.astype(np.int32)), pa.array(ids[row]), pa.array(component[row])],
                                         ["bucket", "band", "doc_id", "component"])


BAND_ROWS = "bucket long, band int, doc_id long, component long"


def _firsts(batches: Iterable) -> Iterator:
    """Rows sorted by (bucket, piece, doc): every doc that is not the first of its piece, with
    the first. Keeps one row of the batch before."""
    import pyarrow as pa

    last = None  # (bucket, piece, first doc) of the group that is open
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, piece, doc = (np.asarray(batch[c]) for c in ("bucket", "piece", "doc_id"))
        new = np.ones(len(doc), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (piece[1:] != piece[:-1])
        first = doc[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
        if last is not None and (bucket[0], piece[0]) == last[:2]:
            end = np.flatnonzero(new[1:])
            first[:end[0] + 1 if len(end) else len(doc)] = last[2]
        last = (bucket[-1], piece[-1], first[-1])
        other = first != doc
        yield pa.RecordBatch.from_arrays([pa.array(doc[other]), pa.array(first[other])], ["a", "b"])


def _estimated(percent: int):
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint16).reshape(-1, 1 << FINE) for c in ("ra", "rb"))
                na, nb = np.asarray(batch["na"]), np.asarray(batch["nb"])
                yield batch.select(["a", "b"]).filter(pa.array(estimate(a, b, na, nb) >= least_estimate(na, nb, percent)))
    return run


def _sets(words: int):
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch["text"].cast(pa.binary()).to_pylist()
            for ids, part in _batches(texts, batch["doc_id"].to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([s.tobytes() for s in shingle_sets(part, words)], pa.binary())],
                    ["doc_id", "shingles"])
    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(percent: int):
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(batch["sa"], batch["sb"])]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


BLOCK = "bucket long, tile long, part int, side int, at int, doc_id long, n_shingles long, others binary"
BLOCK_KEY = ["bucket", "tile", "part"]


def _block(bucket: int, tile: int, part: int, ids: tuple, sizes: tuple, hit: np.ndarray):
    """Rows of the members of both sides that have a candidate; a left one holds its candidates
    among the right ones, as bits."""
    import pyarrow as pa

    left, right = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
    bits = np.packbits(hit[np.ix_(left, right)], axis=1)
    n = len(left) + len(right)
    columns = [np.full(n, bucket), np.full(n, tile), np.full(n, part), np.repeat([0, 1], [len(left), len(right)]),
               np.concatenate([np.arange(len(left)), np.arange(len(right))]), np.concatenate([ids[0][left], ids[1][right]]),
               np.concatenate([sizes[0][left], sizes[1][right]])]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    others = pa.array([x.tobytes() for x in bits] + [b""] * len(right), pa.binary())
    return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types)), others], [c.split()[0] for c in BLOCK.split(", ")])


def _block_parts(bucket: int, tile: int, ids: tuple, sizes: tuple, hit: np.ndarray) -> Iterator:
    """Blocks of a tile's candidates, each with few enough shingles to be held with its sets."""
    part = 0
    runs = [(np.cumsum(n) - n) // BLOCK_SHINGLES for n in sizes]
    for a in np.unique(runs[0]):
        for b in np.unique(runs[1]):
            x, y = np.flatnonzero(runs[0] == a), np.flatnonzero(runs[1] == b)
            some = hit[np.ix_(x, y)]
            if some.any():
                yield _block(bucket, tile, part, (ids[0][x], ids[1][y]), (sizes[0][x], sizes[1][y]), some)
                part += 1


def _blocks(batches: Iterable, payload: list[str]) -> Iterator:
    """(key, candidates, left rows, right rows) of blocks of sorted rows with ``payload``. Several rows
    of one ``at`` are texts under one id."""
    import itertools

    names = [c.split()[0] for c in BLOCK.split(", ")] + payload
    rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in names)))
    for key, group in itertools.groupby(rows, key=lambda r: r[:3]):
        group = list(group)
        left, right = ([r for r in group if r[3] == side] for side in (0, 1))
        width = 1 + max(r[4] for r in right)
        hit = np.zeros((1 + max(r[4] for r in left), width), bool)
        for r in left:
            hit[r[4]] = np.unpackbits(np.frombuffer(r[7], np.uint8), count=width)
        yield key, hit, left, right


def _estimated_blocks(percent: int):
    """Blocks with ``n`` and ``registers`` to blocks of the candidates whose registers estimate enough."""
    def run(batches: Iterable) -> Iterator:
        for key, hit, *sides in _blocks(batches, ["n", "registers"]):
            (la, ln, lr), (ra, rn, rr) = (
                (np.array([r[4] for r in side]), np.array([r[8] for r in side]),
                 np.frombuffer(b"".join(r[9] for r in side), np.uint16).reshape(-1, 1 << FINE)) for side in sides)
            left = np.zeros_like(hit)
            for i in range(len(la)):
                j = np.flatnonzero(hit[la[i], ra])
                if len(j):
                    j = j[estimate(rr[j], lr[i], rn[j], ln[i]) >= least_estimate(rn[j], ln[i], percent)]
                    left[la[i], ra[j]] = True
            if left.any():
                ids, sizes = ([np.zeros(n, np.int64) for n in hit.shape] for _ in range(2))
                for k, side in enumerate(sides):
                    for r in side:
                        ids[k][r[4]], sizes[k][r[4]] = r[5], r[6]
                yield _block(*key, ids, sizes, left)
    return run


def _linked_blocks(percent: int):
    """Blocks with ``shingles`` to links that join the same members as all of the block's."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for _, hit, left, right in _blocks(batches, ["shingles"]):
            above: dict[int, int] = {}

            def top(x: int) -> int:
                while (up := above.get(x, x)) != x:
                    above[x] = above.get(up, up)
                    x = up
                return x
            links, at = [], np.array([r[4] for r in right])
            for x in left:
                mine = np.frombuffer(x[8], np.uint64)
                for j in np.flatnonzero(hit[x[4], at]):
                    y = right[j]
                    a, b = top(x[5]), top(y[5])
                    if a != b and _linked(mine, np.frombuffer(y[8], np.uint64), percent):
                        above[a] = b
                        links.append((x[5], y[5]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])
    return run


def _crossing(percent: int):
    """Tiles of a bucket (rows sorted by bucket, tile, side) to blocks of candidate pairs between
    different components, each in the pair's first common band only, thinned by the
    estimate of the bands' own registers."""
    def blocks(rows) -> Iterator:
        left, right = ([r for r in rows if r[2] == side] for side in (0, 1))
        same = rows[0][1] & 1 == 1  # a tile of others with itself
        right = left if same else right
        if not left or not right:
            return

        def arrays(part):
            coded = b"".join(r[6] for r in part)
            return (np.array([r[3] for r in part]), np.array([r[5] for r in part]), np.frombuffer(coded, np.uint64).reshape(-1, BANDS),
                    np.frombuffer(coded, np.uint16).reshape(-1, 1 << COARSE), np.array([r[7] for r in part]))
        ia, ca, ka, ra, na = arrays(left)
        ib, cb, kb, rb, nb = arrays(right)
        band = rows[0][4]
        hit = np.zeros((len(ia), len(ib)), bool)
        for i in range(len(ia)):
            j = np.flatnonzero((cb != ca[i]) & (np.minimum(nb, na[i]) * 100 >= percent * np.maximum(nb, na[i])))
            if same:
                j = j[j > i]
            if not len(j):
                continue
            common = (kb[j] == ka[i]) & (ka[i] != 0)
            j = j[common.argmax(1) == band]
            if not len(j):
                continue
            hit[i, j[estimate(rb[j], ra[i], nb[j], na[i], COARSE) >= least_estimate(nb[j], na[i], percent, COARSE)]] = True
        if hit.any():
            yield from _block_parts(rows[0][0], rows[0][1], (ia, ib), (na, nb), hit)

    def run(batches: Iterable) -> Iterator:
        import itertools

        names = ["bucket", "tile", "side", "doc_id", "band", "component", "bands", "n_shingles"]
        rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in names)))
        for _, group in itertools.groupby(rows, key=lambda r: r[:2]):
            yield from blocks(list(group))
    return run


def crossing_tiles(members: DataFrame, total: int) -> DataFrame:
    """Members (``bucket, band, doc_id, component``) of buckets with several components, for
    each tile in which they meet others (``tile``, ``side``).

    Pairs inside one component need no test, so the members of a bucket's largest component
    (``most``) are one side that never meets itself: each of them goes to the tiles of the
    others, few if there are few. The others also meet one another."""
    sizes = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    facts = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("components"))
    facts = stored(facts.where("components > 1").select(
        "bucket", "size", F.col("top.component").alias("most"), F.col("top.n").alias("of_most")), "near-open")
    held = join_shared(members, facts, "bucket", "size", total)
    inner, outer = (F.greatest(F.ceil(n / TILE), F.lit(1)).cast("long") for n in (F.col("of_most"), F.col("size") - F.col("of_most")))
    is_most = F.col("component") == F.col("most")
    own = F.pmod(F.xxhash64("doc_id"), F.when(is_most, inner).otherwise(outer))
    held = held.withColumns({"_inner": inner, "_outer": outer, "_most": is_most, "_own": own})
    # tile numbers: (piece of the others, piece of the largest component), doubled; or
    # (lesser, greater piece of the others), doubled and past those
    at = lambda o, p: (o * F.col("_inner") + p) * 2
    past = F.col("_outer") * F.col("_inner") * 2
    each = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    to_most = F.transform(each(F.col("_outer")), lambda o: F.struct(at(o, F.col("_own")).alias("tile"), F.lit(1).alias("side")))
    to_others = F.concat(
        F.transform(each(F.col("_inner")), lambda p: F.struct(at(F.col("_own"), p).alias("tile"), F.lit(0).alias("side"))),
        F.transform(each(F.col("_outer")), lambda o: F.struct(
            (past + (F.least(o, F.col("_own")) * F.col("_outer") + F.greatest(o, F.col("_own"))) * 2 + F.when(o == F.col("_own"), 1).otherwise(0)).alias("tile"),
            F.when(o < F.col("_own"), 1).otherwise(0).alias("side"))))
    dealt = held.withColumn("_to", F.explode(F.when(F.col("_most"), to_most).otherwise(to_others)))
    return dealt.select(*members.columns, F.col("_to.tile").alias("tile"), F.col("_to.side").alias("side"))


@in_small_batches
def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``body`` (text hash), ``n_shingles``, ``component_id``, ``kept`` of every row of ``docs``.

    Reads ``doc_id`` (integer) and ``text``. Two texts are linked when their sets of distinct
    ``words``-word shingles (ASCII lower-cased, split at ASCII white space) have a
    Jaccard similarity of at least ``percent`` / 100; a text with fewer words is one
    shingle. ``component_id`` is the least doc_id reachable by links, ``kept`` marks it.
    NULL or wordless texts have an empty set and no links. A row without doc_id has
    component NULL and is kept. Texts under one doc_id are nodes of one name: what is
    linked to one of them is linked to the others that the id stands for. Other columns
    are not read."""
    parts = shuffle_partitions(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = stored(docs.withColumn("body", F.xxhash64("text")).mapInArrow(_signatures(words), SIGNATURE), "near-signatures")
    worded = sig.where("n_shingles > 0 and doc_id is not null")
    classes = stored(worded.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size")), "near-classes")
    total = sig.count()
    # one signature for each class: that of its representative
    reps = worded.alias("s").join(classes.alias("c"), (F.col("s.digest") == F.col("c.digest")) & (F.col("s.doc_id") == F.col("c.rep")),
                                  "left_semi").dropDuplicates(["doc_id", "digest"]).drop("digest")
    reps = stored(reps, "near-reps")

    def band_rows(docs_: DataFrame) -> DataFrame:
        return docs_.select("doc_id", "bands", "component").mapInArrow(_band_rows, BAND_ROWS)

    bands = band_rows(reps.withColumn("component", F.col("doc_id")))
    # buckets of more than 1/HOT_SHARE of the rows, fewer than HOT_SHARE, are dealt in pieces
    limit = max(1, BANDS * total // HOT_SHARE)
    hot = [r.bucket for r in bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > limit).collect()]
    many = F.col("bucket").isin(hot) if hot else F.lit(False)

    def sets_of(wanted: DataFrame, name: str) -> DataFrame:
        """``doc_id``, ``shingles`` of the wanted ids."""
        return stored(docs.join(wanted.distinct(), "doc_id", "left_semi").mapInArrow(_sets(words), "doc_id long, shingles binary")
                      .dropDuplicates(["doc_id", "shingles"]), name + "-sets")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        """Links among candidate (a, b), tested on full sets."""
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), name)
        sides = join_salted(pairs, sets.withColumnsRenamed({"doc_id": "b", "shingles": "sb"}), "b", "a")
        sides = join_salted(sides, sets.withColumnsRenamed({"doc_id": "a", "shingles": "sa"}), "a", "b", sizes=pairs)
        return stored(sides.select("a", "b", "sa", "sb").mapInArrow(_confirmed(percent), "a long, b long").distinct(), name)

    # round 1: every member of a bucket (or of a piece of a hot one) against the least member
    def against_first(rows: DataFrame, piece) -> DataFrame:
        sorted_ = rows.select("bucket", piece.alias("piece"), "doc_id").repartition(parts, "bucket", "piece").sortWithinPartitions("bucket", "piece", "doc_id")
        return sorted_.mapInArrow(_firsts, "a long, b long")

    pieces = F.when(many, F.pmod(F.xxhash64("doc_id"), F.lit(HOT_PIECES)).cast("int")).otherwise(0)
    star = against_first(bands, pieces)
    if hot:  # the pieces' least members meet in turn
        least = bands.where(many).groupBy("bucket", pieces.alias("piece")).agg(F.min("doc_id").alias("doc_id"))
        star = star.unionByName(against_first(least, F.lit(0)))
    star = stored(star.distinct(), "near-star")
    side = reps.select("doc_id", F.col("n_shingles").alias("n"), "registers")

    def estimated(pairs: DataFrame, name: str) -> DataFrame:
        """Candidate (a, b) whose registers estimate enough."""
        with_b = join_salted(pairs, side.withColumnsRenamed({"doc_id": "b", "n": "nb", "registers": "rb"}), "b", "a")
        both = join_salted(with_b, side.withColumnsRenamed({"doc_id": "a", "n": "na", "registers": "ra"}), "a", "b", sizes=pairs)
        return stored(both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_estimated(percent), "a long, b long"), name)

    links = confirmed(estimated(star, "near-pairs"), "near-links")
    label = stored(components(links), "near-components")

    # round 2: pairs that cross components, where a bucket still holds several
    labelled = reps.select("doc_id", "bands", "n_shingles").join(label.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id", "left")
    labelled = stored(labelled.withColumn("component", F.coalesce("component", "doc_id")), "near-labelled")
    sided = crossing_tiles(band_rows(labelled), max(1, BANDS * total)).join(labelled.select("doc_id", "n_shingles", "bands"), "doc_id")
    dealt = sided.repartition(parts, "bucket", "tile").sortWithinPartitions("bucket", "tile", "side", "doc_id")
    cross = dealt.select("bucket", "tile", "side", "doc_id", "band", "component", "bands", "n_shingles").mapInArrow(_crossing(percent), BLOCK)

    def tested(blocks: DataFrame, facts: DataFrame, test, schema: str, name: str) -> DataFrame:
        """The members of every block, with their ``facts``, in one group for ``test``."""
        held = join_salted(blocks, facts, "doc_id", "tile").repartition(parts, *BLOCK_KEY)
        columns = [c.split()[0] for c in BLOCK.split(", ")] + [c for c in facts.columns if c != "doc_id"]
        return stored(held.select(columns).sortWithinPartitions(*BLOCK_KEY, "side", "at").mapInArrow(test(percent), schema), name)

    cross = tested(stored(cross, "near-crossing"), side, _estimated_blocks, BLOCK, "near-crossing-blocks")
    more = tested(cross, sets_of(cross.select("doc_id"), "near-more"), _linked_blocks, "a long, b long", "near-more")
    label = components(links.unionByName(more))

    facts = classes.join(label.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", "size", F.coalesce("component", "rep").alias("component_id"))
    rows = sig.select("doc_id", "body", "n_shingles", "digest")
    linked = join_group_facts(rows.where("n_shingles > 0 and doc_id is not null"), stored(facts, "near-facts"), "digest", "size", total)
    alone = rows.where("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    names = ["doc_id", "body", "n_shingles", "component_id"]
    out = linked.select(names).unionByName(alone.select(names))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


#: Most rows whose keys (16 bytes each) are broadcast to take them out; more are taken out by a shuffle.
MAX_BROADCAST_KEYS = 1_000_000


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows that :func:`near_duplicates` does not keep: of every
    component the document with the least doc_id stays. All columns stay as they are."""
    judged = near_duplicates(docs, words, percent)
    out = stored(judged.where(~F.col("kept")).select("doc_id", "body").distinct(), "near-dropped")
    if out.count() <= MAX_BROADCAST_KEYS:
        out = F.broadcast(out)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("body"))
    return rows.join(out, ["doc_id", "body"], "left_anti").select("row.*")
