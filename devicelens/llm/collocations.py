"""Phrase collocations by top-order marginalisation (operator 12).

Every word of a piece of text opens one window of three words (its lead columns), padded
with empty words where the piece ends. Only these longest windows are counted; a ROLLUP
over (language, first, second, third word) sums them to the counts of all shorter
phrases, since a phrase occurs once for every window that begins with it.

Most windows of a corpus occur once or twice and can be part of no phrase with the wanted
count. So two passes count hashes first: words and pairs of adjacent words, then windows
whose pairs are frequent; each keeps the frequent ones as a bitmap. The last pass cuts a
window at the first word, pair or window that they do not hold, and counts it by its words.
The cut changes no count of a phrase that is frequent: all its parts are. A bit that is set
by another pair, or a bitmap that has reached its bound, cuts less and changes no count
either. What is cut counts in columns of its own, on the row of another window that begins
alike (``more1``: one word, ``more2``: two), so that it costs no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_group_facts, join_salted, stored
from .hyperminhash import mix
from .ranks import numbered

ORDER = 3                    # words of a window
LEAST = 10                   # occurrences of a candidate
TOP = 2000                   # phrases reported for a language
INSIDE = 50                  # percent of a phrase's occurrences that a longer one may take
UNKNOWN = "und"
GROUP_BYTES = 4 << 20        # text of one language counted at once
HELD_BYTES = 16 << 20        # text of all languages that a task holds
BITS_PER_HASH = 16
#: Bits of a hash that is counted; parts that share them count together.
HASH_BITS = 40
#: Bound of a bitmap (32 MB); beyond it windows are cut less often, with the same result.
MAX_BITS = 1 << 28
MAP_BITS = 1 << 15           # bits of a row that builds the bitmap

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BREAK = np.array([c in b".,;:!?" or 0x0A <= c <= 0x0D for c in range(256)])
GAP = BREAK | np.array([c in b" \t" for c in range(256)])
BREAKS = re.compile(rb"[.,;:!?\x0A-\x0D]")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _short(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - HASH_BITS)


class Words:
    """Words of a text: dictionary, number of each word, and where the next one follows it."""

    def __init__(self, text: bytes, lang: str):
        import pyarrow as pa
        import xxhash

        flat = np.frombuffer(text.translate(LOWER), np.uint8)
        inside = ~GAP[flat]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(flat[inside])])
        coded = words.dictionary_encode()
        self.distinct, self.ids = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
        breaks = np.cumsum(BREAK[flat])
        self.follows = np.zeros(len(starts), bool)
        self.follows[:-1] = breaks[starts[1:]] == breaks[ends[:-1] - 1]
        seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.distinct.to_pylist()], np.uint64)
        self.seeded = mix(hashes + seed) * _B
        self.hashes = hashes

    def singles(self) -> np.ndarray:
        """Hashes of the distinct words."""
        return _short(mix(self.hashes + self.seeded))

    def pairs(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the words at some places with the next ones."""
        return _short(mix(self.hashes[self.ids[at]] * _A + self.seeded[self.ids[at + 1]]))

    def triples(self, at: np.ndarray) -> np.ndarray:
        first = mix(self.hashes[self.ids[at]] * _A + self.seeded[self.ids[at + 1]])
        return _short(mix(first * _A + self.seeded[self.ids[at + 2]]))

    def strings(self):
        """Words by number from 1, and the empty one at 0."""
        import pyarrow as pa

        return pa.concat_arrays([pa.array([b""], pa.large_binary()), self.distinct]).cast(pa.large_string()).cast(pa.string())


def parts(texts: Iterable[tuple[str, bytes]]) -> Iterator[tuple[str, bytes]]:
    """(language, text) of about GROUP_BYTES; texts are joined and long ones cut at breaks only."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in texts:
        at = 0
        while at < len(text):
            cut = BREAKS.search(text, at + GROUP_BYTES) if len(text) - at > GROUP_BYTES else None
            end = cut.end() if cut else len(text)
            held.setdefault(lang, []).append(text[at:end])
            sizes[lang] = sizes.get(lang, 0) + end - at
            at = end
            if sizes[lang] >= GROUP_BYTES:
                yield lang, b"\n".join(held.pop(lang))
                sizes.pop(lang)
        if sum(sizes.values()) >= HELD_BYTES:
            yield from ((k, b"\n".join(v)) for k, v in held.items())
            held, sizes = {}, {}
    yield from ((k, b"\n".join(v)) for k, v in held.items())


def _rows(batches: Iterable) -> Iterator[tuple[str, bytes]]:
    import pyarrow as pa

    for batch in batches:
        yield from zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist())


def _hash_counts(first):
    """Counts of hashes: of words and pairs or, given their bitmap, of windows with frequent pairs."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for lang, text in parts(_rows(batches)):
            words = Words(text, lang)
            if first is None:
                hashes, n = np.unique(words.pairs(np.flatnonzero(words.follows)), return_counts=True)
                singles = words.singles()
                hashes, n = np.concatenate([hashes, singles]), np.concatenate([n, np.bincount(words.ids, minlength=len(singles))])
            else:
                goes_on = frequent(words, np.frombuffer(first.value, np.uint8))[1]
                hashes, n = np.unique(words.triples(np.flatnonzero(goes_on[:-1] & goes_on[1:])), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"])
    return run


def held(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Which hashes the bitmap (a power of two bits) holds; a hash takes one bit."""
    bit = hashes & np.uint64(len(bitmap) * 8 - 1)
    return bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 == 1


def frequent(words: Words, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is each distinct word frequent, is each word frequent with the next one)"""
    single, goes_on = held(words.singles(), first), np.zeros(len(words.ids), bool)
    at = np.flatnonzero(words.follows)
    at = at[single[words.ids[at]] & single[words.ids[at + 1]]]
    goes_on[at] = held(words.pairs(at), first)
    return single, goes_on


def windows(words: Words, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """([window, place] word numbers from 1, 0 for none; [window, 3] counts of the window, of
    those cut after its first word, and after its second) of the windows of all words."""
    n = len(words.ids)
    single, goes_on = frequent(words, first)
    whole = np.flatnonzero(goes_on[:-1] & goes_on[1:])
    whole = whole[held(words.triples(whole), second)]
    ids = np.where(single, np.arange(1, len(single) + 1), 0)[words.ids]
    columns = [ids, np.zeros(n, np.int64), np.zeros(n, np.int64)]
    columns[1][goes_on] = ids[np.flatnonzero(goes_on) + 1]
    columns[2][whole] = ids[whole + 2]
    base, key = len(words.distinct) + 1, columns[0]
    for k, column in enumerate(columns[1:]):  # prefixes are numbered anew, so that no product passes 64 bits
        key = (np.unique(key, return_inverse=True)[1] if k else key) * base + column
    _, at, found = np.unique(key, return_index=True, return_counts=True)
    rows = np.stack([c[at] for c in columns], 1)
    counts = np.zeros((len(rows), ORDER), np.int64)
    counts[:, 0] = found
    # in the order of keys a cut window stands right before those that begin alike
    for size in (2, 1):
        cut = (rows[:-1, size] == 0) & (rows[:-1, size - 1] > 0) & (rows[:-1, :size] == rows[1:, :size]).all(1)
        at = np.flatnonzero(cut)
        counts[at + 1, size] += counts[at, 0]
        keep = np.ones(len(rows), bool)
        keep[at] = False
        rows, counts = rows[keep], counts[keep]
    return rows, counts


def _window_counts(first, second):
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        bitmaps = [np.frombuffer(x.value, np.uint8) for x in (first, second)]
        for lang, text in parts(_rows(batches)):
            words = Words(text, lang)
            ids, counts = windows(words, *bitmaps)
            table = words.strings()
            for k in range(0, len(ids), 1 << 16):
                part, n = ids[k:k + (1 << 16)], counts[k:k + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(part)), *(table.take(pa.array(part[:, j])) for j in range(ORDER)),
                     *(pa.array(np.ascontiguousarray(n[:, j])) for j in range(ORDER))], ["lang", *_WORDS, *_COUNTS])
    return run


_WORDS = [f"w{k}" for k in range(1, ORDER + 1)]
_COUNTS = ["n", "more1", "more2"]


def frequent_hashes(rows: DataFrame, least: int, first=None) -> bytes:
    """Bitmap of the hashes that occur ``least`` times or more (see :func:`_hash_counts`)."""
    hashes = rows.mapInArrow(_hash_counts(first), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    hashes = stored(hashes.where(F.col("n") >= least).select("hash"), "phrase-hashes")
    bits = min(MAX_BITS, 1 << max(15, (hashes.count() * BITS_PER_HASH).bit_length()))
    bit = F.col("hash").bitwiseAND(bits - 1)
    maps = hashes.groupBy(F.shiftrightunsigned(bit, 15).alias("at")).agg(F.expr(f"bitmap_construct_agg(hash & {MAP_BITS - 1})").alias("bitmap"))
    out = bytearray(bits // 8)
    for row in maps.toLocalIterator():  # MAX_BITS / 8 bytes at most
        out[row.at * MAP_BITS // 8:(row.at + 1) * MAP_BITS // 8] = row.bitmap
    return bytes(out)


def phrase_counts(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(``lang``, ``size``, ``w1``, ``w2``, ``w3``, ``n``): occurrences of every phrase of one to
    three words that occurs ``least`` times or more, and of all words of a language (size 0)."""
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    share = docs.sparkSession.sparkContext.broadcast
    first = share(frequent_hashes(rows, least))
    second = share(frequent_hashes(rows, least, first))
    fields = [*(f"{w} string" for w in ("lang", *_WORDS)), *(f"{c} long" for c in _COUNTS)]
    counted = rows.mapInArrow(_window_counts(first, second), ", ".join(fields))
    sums = counted.rollup("lang", *_WORDS).agg(*[F.sum(c).alias(c) for c in _COUNTS], F.grouping_id().alias("g"))
    size, last, n = F.lit(None).cast("int"), F.lit(None).cast("string"), F.col("n")
    for k in range(ORDER + 1):  # the grouping id has a bit for each word that is summed over
        whole = F.col("g") == (1 << (ORDER - k)) - 1
        size = F.when(whole, F.lit(k)).otherwise(size)
        last = F.when(whole, F.col(_WORDS[k - 1]) if k else F.lit("-")).otherwise(last)
        # windows cut after a word hold no longer phrase
        n = F.when(whole, sum((F.col(c) for j, c in enumerate(_COUNTS) if j == 0 or j >= k), F.lit(0))).otherwise(n)
    sums = sums.withColumns({"size": size, "last": last, "n": n})
    return sums.where((F.col("last") != "") & ((F.col("size") == 0) | (F.col("n") >= least))).select("lang", "size", *_WORDS, "n")


def _phrase(*words: str) -> Column:
    """Words joined by spaces; those summed over are NULL and left out."""
    return F.concat_ws(" ", *words)


def cut_score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)), exactly; a is at most l and at most r."""
    wide = lambda c: c.cast("decimal(38,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(38,0)") * wide(a) * wide(a), wide(l) * wide(r))


def collocations(docs: DataFrame, least: int = LEAST, inside: int = INSIDE, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, phrase, size, a, l, r, n, score`` of every phrase of two or three words that
    occurs ``least`` times in a language and is not mostly part of a longer one.

    Texts are lower-cased (A-Z) and broken at ``. , ; : ! ?`` and line ends; words are what
    spaces and tabs separate. ``a`` counts the phrase, ``n`` all words of the language (NULL
    language: ``und``). The score floor(10**6 a^2 / (l r)) is the lowest over the phrase's
    cuts into a first part (``l``) and the rest (``r``). A phrase goes when a longer one that
    holds it, itself a candidate, has at least ``inside`` percent of its occurrences. NULL and
    wordless texts have no phrases; repeated rows count as often as they stand there; an empty
    table gives an empty result; other columns are not read."""
    counts = stored(phrase_counts(docs, least, lang_col, text_col), "phrase-counts")
    facts = counts.where("size between 1 and 2").select(F.struct("lang", _phrase("w1", "w2").alias("s")).alias("part"), F.col("n").alias("f"))
    two, three = (counts.where(F.col("size") == k).select("lang", *_WORDS, "n") for k in (2, 3))

    def needs(*pieces: tuple[str, ...]) -> Column:
        return F.explode(F.array(*[F.struct(F.lit(k).alias("role"), F.struct("lang", _phrase(*p).alias("s")).alias("part")) for k, p in enumerate(pieces)]))

    wanted = two.select("lang", _phrase("w1", "w2").alias("phrase"), F.lit(2).alias("size"), F.col("n").alias("a"), needs(("w1",), ("w2",)).alias("p"))
    wanted = wanted.unionByName(three.select("lang", _phrase(*_WORDS).alias("phrase"), F.lit(3).alias("size"), F.col("n").alias("a"),
                                             needs(("w1",), ("w2", "w3"), ("w1", "w2"), ("w3",)).alias("p")))
    wanted = stored(wanted.select("lang", "phrase", "size", "a", "p.role", "p.part"), "phrase-parts")
    found = join_salted(wanted, facts, "part", "phrase")
    role = lambda k: F.max(F.when(F.col("role") == k, F.col("f")))
    known = found.groupBy("lang", "phrase", "size", "a").agg(*[role(k).alias(f"f{k}") for k in range(4)])
    first, second = (cut_score(F.col("a"), F.col(f"f{k}"), F.col(f"f{k + 1}")) for k in (0, 2))
    later = F.coalesce(second < first, F.lit(False))
    scored = known.select("lang", "phrase", "size", "a", F.when(later, F.col("f2")).otherwise(F.col("f0")).alias("l"),
                          F.when(later, F.col("f3")).otherwise(F.col("f1")).alias("r"), F.when(later, second).otherwise(first).alias("score"))
    within = three.select("lang", "n", F.explode(F.array(_phrase("w1", "w2"), _phrase("w2", "w3"))).alias("phrase"))
    within = within.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    left = scored.join(within.hint("merge"), ["lang", "phrase"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * inside, F.lit(True)))
    left = stored(left.drop("longer"), "phrase-scores")
    sizes = left.groupBy("lang").agg(F.count(F.lit(1)).alias("phrases"))
    totals = counts.where("size = 0").select("lang", F.col("n").alias("words")).join(sizes, "lang")
    out = join_group_facts(left, totals, "lang", "phrases", left.count())
    return out.select("lang", "phrase", "size", "a", "l", "r", F.col("words").alias("n"), "score")


def top_collocations(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """:func:`collocations` with ``rank`` from 1 in each language, by score, then count (both
    descending), then phrase; the first ``top`` of each."""
    order = [F.asc("lang"), F.desc("score"), F.desc("a"), F.asc("phrase")]
    placed = numbered(collocations(docs, **options), order, "place", "phrase-places")
    first = placed.groupBy("lang").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("phrases"))
    rows = join_group_facts(placed, stored(first, "phrase-firsts"), "lang", "phrases", placed.count())
    rows = rows.withColumn("rank", F.col("place") - F.col("first") + 1).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
