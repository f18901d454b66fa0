"""Line dedup by an exact set-similarity join (operator 5).

A line is the set of its lower-cased words. Lines of the same text form a class, and
only the first line of a class takes part in the join. Its words are ordered by
rarity; two sets with a Jaccard similarity of 0.8 share a word among the rarest few
(prefix filter), at places that leave enough words behind them (positional filter),
are of like length (length filter), and differ in few bits of a parity bitmap.
Candidates are verified on their whole sets, and the later line of a match goes.

A line needs one earlier match only. So round 1 tries each line against the earliest
line of each of its prefix words (linear in any group), and round 2 joins the rest: open
lines with one another, and with the earlier of those that are settled, under words of three
lines or more, without the word's earliest. Prefix entries are
written once, under the place of their text in the order of ids; a table goes as soon as
the next ones are written. Words are counted, hashed and ordered with numpy in the tasks;
classes, joins and verification are DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, dropped, in_small_batches, join_group_facts, join_salted, recorded, stored
from .hyperminhash import BATCH_BYTES
from .hyperminhash import word_hashes as byte_word_hashes
from .ranks import numbered

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
#: Words are counted in cells of their hash: a table of fixed size, whatever the vocabulary.
CELL_BITS = 17
#: Most lines whose keys (20 bytes each) are broadcast, to take them out or to fetch
#: their words; more meet by a shuffle.
MAX_BROADCAST_LINES = 1_000_000
LAST = (1 << 63) - 1
LINE_BITS = 31              # of a line's key: its place above, its number in the text below
HOT_PIECES = 32             # pieces of a hot word in round 2
ENTRIES = "at long, n int, parity long, parity2 long, pos int, word long"


def word_hashes(line: Column) -> Column:
    """64-bit hashes of a line's distinct words."""
    words = F.array_distinct(F.array_remove(F.split(F.lower(line), SPACES), ""))
    return F.transform(words, lambda w: F.xxhash64(w))


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """Words that sets of these sizes must share."""
    return F.ceil((a + b) * percent / (100 + percent))


def _placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``doc``: id, ``body``: text hash, ``place``) of every distinct pair, in the order of ids
    (NULL last), then text hashes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("body")).distinct()
    return numbered(keys, [F.asc("doc"), F.asc("body")], "place", "line-places")


def _with_place(rows: DataFrame, places: DataFrame) -> DataFrame:
    return rows.join(bounded(places), ["doc", "body"], "left")


def _lines(docs: DataFrame, places: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``at``: key of a line, rising in the order of texts and lines, ``words_of``: its text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("body"), text.alias("text"))
    lines = _with_place(rows, places).select("place", F.posexplode(F.split("text", "\n")).alias("line", "words_of"))
    return lines.select(F.shiftleft("place", LINE_BITS).bitwiseOR(F.col("line").cast("long")).alias("at"), "words_of")


def bounded(keys: DataFrame) -> DataFrame:
    """Line keys, to be broadcast if there are few enough."""
    return F.broadcast(keys) if keys.count() <= MAX_BROADCAST_LINES else keys


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about BATCH_BYTES, cut between words."""
    if len(text) <= 2 * BATCH_BYTES:
        yield text
        return
    words, size = [], 0
    for w in text.split():
        words.append(w)
        size += len(w) + 1
        if size > BATCH_BYTES:
            yield b" ".join(words)
            words, size = [], 0
    yield b" ".join(words)


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words of the texts, the number of each one's text); the texts hold
    no line ends, or there is one text."""
    if len(texts) == 1:
        h = np.concatenate([_hashes(p)[0] for p in _pieces(texts[0])])
        return h, np.zeros(len(h), np.int64)
    h, starts = _hashes(b"\n".join(texts))
    return h, np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not data:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return byte_word_hashes(data, 1 << max(16, (len(data) + 1).bit_length()))


def _groups(column) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of runs of rows of about BATCH_BYTES; a long text is a run of its own."""
    first, got, size = 0, [], 0
    for i, t in enumerate(column):
        if got and size + len(t) > BATCH_BYTES:
            yield first, got
            first, got, size = i, [], 0
        got.append(t)
        size += len(t) + 1
    if got:
        yield first, got


def _counted(batches: Iterable) -> Iterator:
    """Lower-cased texts to (cell, count of words), once a task."""
    import pyarrow as pa

    counts = np.zeros(1 << CELL_BITS, np.int64)
    for batch in batches:
        for _, texts in _groups(batch["low"].cast(pa.binary()).to_pylist()):
            for piece in _pieces(b"\n".join(texts)):
                cells = _hashes(piece)[0] & np.uint64((1 << CELL_BITS) - 1)
                counts += np.bincount(cells.astype(np.int64), minlength=1 << CELL_BITS)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())], ["cell", "n"])


def cell_levels(docs: DataFrame, text_col: str) -> bytes:
    """A number below 128 for every cell of words, rising with the logarithm of its count.

    The counts cover all lines; the driver gets one number a cell, 2**CELL_BITS at most."""
    low = docs.select(F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("low"))
    levels = bytearray(1 << CELL_BITS)
    for row in low.mapInArrow(_counted, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():
        levels[row.cell] = min(127, int(4 * math.log2(row.n + 1)))
    return bytes(levels)


def _prefixes(levels: bytes, percent: int):
    """mapInArrow over (``at``, ``low``: lower-cased line) to the entries of its prefix words.

    A line's words are 64-bit keys, the rarest first: level of the word's cell, then its
    hash. ``parity`` and ``parity2`` are the parities of the words in 128 cells."""
    table = np.frombuffer(levels, np.uint8)
    one = np.uint64(1)

    def entries(at: np.ndarray, texts: list[bytes]):
        h, row = _hashed(texts)
        keys = (table[(h & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))
        order = np.lexsort((keys, row))
        keys, row = keys[order], row[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
        keys, row = keys[new], row[new]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        n = np.diff(np.append(first, len(keys)))
        bit, upper = one << (keys & np.uint64(63)), (keys & np.uint64(64)) != 0
        parities = [np.bitwise_xor.reduceat(np.where(upper == half, bit, np.uint64(0)), first).view(np.int64) for half in (False, True)]
        pos = np.arange(len(keys)) - np.repeat(first, n)
        probing = n - -(-n * percent // 100) + 1
        some = pos < np.repeat(probing, n)
        line = np.repeat(np.arange(len(n)), n)[some]
        return at[row[first]][line], n[line], parities[0][line], parities[1][line], pos[some], keys[some].view(np.int64)

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        for batch in batches:
            at = np.asarray(batch["at"])
            for k, texts in _groups(batch["low"].cast(pa.binary()).to_pylist()):
                columns = entries(at[k:k + len(texts)], texts)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in ENTRIES.split(", ")])
    return run


@in_small_batches
def similar_lines(docs: DataFrame, places: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``at`` of every line that has an earlier match; see :func:`dedup_lines`."""
    spark, spent = docs.sparkSession, []
    raw = _lines(docs, places, id_col, text_col)
    low = F.lower("words_of")
    with recorded(spent):
        lines = stored(raw.where(F.col("words_of").rlike(WORD)).select(
            "at", F.xxhash64(low).alias("s1"), F.xxhash64(F.lit(1), low).alias("s2")), "lines")
        classes = stored(lines.groupBy("s1", "s2").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
                         .where("size > 1").select(F.struct("s1", "s2").alias("s"), "first", "size"), "line-classes")
    repeats = stored(join_group_facts(lines.withColumn("s", F.struct("s1", "s2")), classes, "s", "size", lines.count())
                     .where(F.col("at") != F.col("first")).select("at").distinct(), "line-repeats")
    dropped(spark, spent)

    # prefixes of the first lines of all classes
    levels = cell_levels(docs, text_col)
    single = raw.where(F.col("words_of").rlike(WORD)).join(bounded(repeats), "at", "left_anti")
    with recorded(spent):
        entries = stored(single.select("at", F.lower("words_of").alias("low")).mapInArrow(_prefixes(levels, percent), ENTRIES), "line-prefixes")
    fields = ["at", "n", "pos", "parity", "parity2"]
    side = F.struct(*fields)
    total = entries.count()

    def close(a: str, b: str) -> Column:
        """Length, positional and bitmap filters on two entries of one word."""
        na, nb = F.col(f"{a}n"), F.col(f"{b}n")
        need = least_overlap(na, nb, percent)
        rest = 1 + F.least(na - F.col(f"{a}pos") - 1, nb - F.col(f"{b}pos") - 1)
        apart = sum((F.bit_count(F.col(f"{a}{p}").bitwiseXOR(F.col(f"{b}{p}"))) for p in ("parity", "parity2")), F.lit(0))
        return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (rest >= need) & (na + nb - apart >= 2 * need)

    # round 1: the earliest line of each prefix word; words of one prefix only propose nothing
    with recorded(spent):
        earliest = stored(entries.groupBy("word").agg(F.min(side).alias("e"), F.count(F.lit(1)).alias("size")).where("size > 1"), "line-earliest")
    limit = max(1, total // HOT_SHARE)
    hot = [r.word for r in earliest.where(F.col("size") > limit).select("word").collect()]  # fewer than HOT_SHARE
    first = join_group_facts(entries, earliest, "word", "size", total)
    # with the earliest line of a word all others are tried here, so round 2 needs the others of three or more only
    tried = F.when((F.col("at") > F.col("e.at")) & close("", "e."), F.col("e.at"))
    held: list[str] = []
    with recorded(held):
        rest = stored(first.where("at != e.at").select(*fields, "word", (F.col("size") > 2).alias("more"), tried.alias("earlier"))
                      .where("more or earlier is not null"), "line-rest")
    dropped(spark, spent)
    star = stored(rest.where("earlier is not null").select(F.col("at").alias("later"), "earlier").distinct(), "line-star")
    found = stored(verified(docs, places, star, percent, id_col, text_col, "line-found").select("later").distinct(), "line-resolved")

    # round 2: lines without a match so far, against every earlier line
    done = found.select(F.col("later").alias("at"), F.lit(True).alias("done"))
    marked = rest.where("more").join(bounded(done), "at", "left").withColumn("done", F.coalesce("done", F.lit(False)))
    indexing = F.col("pos") < F.col("n") - F.ceil(F.col("n") * 2 * percent / (100 + percent)) + 1

    def meet(longer: DataFrame, shorter: DataFrame, order: str) -> DataFrame:
        """Pairs (longer or equal and later, ``y_``: indexed) under one word; a hot word's longer lines in pieces."""
        salt, each = F.lit(0), F.array(F.lit(0))
        if hot:
            many = F.col("word").isin(hot)
            salt = F.when(many, F.pmod(F.xxhash64("at"), F.lit(HOT_PIECES)).cast("int")).otherwise(0)
            each = F.when(many, F.sequence(F.lit(0), F.lit(HOT_PIECES - 1))).otherwise(each)
        a = longer.select("word", salt.alias("salt"), *fields)
        b = shorter.select("word", F.explode(each).alias("salt"), *(F.col(c).alias(f"y_{c}") for c in [*fields, "done"]))
        if not hot:
            a, b = a.drop("salt"), b.drop("salt")
        pairs = a.join(b, ["word", "salt"] if hot else ["word"]).where(
            F.expr("n > y_n or (n = y_n and at > y_at)") & F.expr(order) & close("", "y_"))
        return pairs.select(F.greatest("at", "y_at").alias("later"), F.least("at", "y_at").alias("earlier"))

    open_, settled = marked.where(~F.col("done")), marked.where(F.col("done"))
    pairs = meet(open_, marked.where(indexing), "at > y_at or not y_done").unionByName(meet(settled, open_.where(indexing), "y_at > at"))
    pairs = stored(pairs.distinct(), "line-pairs")
    dropped(spark, held)
    more = verified(docs, places, pairs, percent, id_col, text_col, "line-more").select("later")
    near = found.unionByName(more).distinct().select(F.col("later").alias("at"))
    return repeats.unionByName(near)


def verified(docs: DataFrame, places: DataFrame, pairs: DataFrame, percent: int, id_col: str, text_col: str, name: str) -> DataFrame:
    """Those of (later, earlier) whose whole sets have the similarity."""
    wanted = stored(pairs.select(F.explode(F.array("later", "earlier")).alias("at")).distinct(), name + "-wanted")
    sets = (_lines(docs, places, id_col, text_col).join(bounded(wanted), "at", "left_semi")
            .select("at", word_hashes(F.col("words_of")).alias("set")).dropDuplicates(["at"]))
    sets = stored(sets, name + "-sets")
    a = sets.select(F.col("at").alias("later"), F.col("set").alias("a"))
    b = sets.select(F.col("at").alias("earlier"), F.col("set").alias("b"))
    both = join_salted(join_salted(pairs, b, "earlier", "later"), a, "later", "earlier", sizes=pairs)
    shared = F.size(F.array_intersect("a", "b"))
    return stored(both.where(shared * 100 >= (F.size("a") + F.size("b") - shared) * percent).select("later", "earlier"), name)


def _shortened(docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(``row``: a row of ``docs``, ``left``: its text without removed lines, ``n_lines``, ``n_removed``)."""
    places = _placed(docs, id_col, text_col)
    lines = stored(similar_lines(docs, places, percent, id_col, text_col).distinct(), "line-gone")
    line = F.col("at").bitwiseAND((1 << LINE_BITS) - 1).cast("int")
    gone = lines.groupBy(F.shiftright("at", LINE_BITS).alias("place")).agg(F.collect_list(line).alias("gone"))
    if lines.count() <= MAX_BROADCAST_LINES:
        gone = F.broadcast(gone)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"),
                       F.xxhash64(text).alias("body"))
    rows = _with_place(rows, places).join(gone, "place", "left").withColumn("lines", F.split(F.coalesce(f"row.{text_col}", F.lit("")), "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    left = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return rows.select("row", F.when(F.col("gone").isNull(), F.col(f"row.{text_col}")).otherwise(left).alias("left"),
                       F.size("lines").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"))


def _columns(docs: DataFrame, replaced: dict[str, Column]) -> list[Column]:
    return [replaced.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]


def dedup_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its later matching lines removed, and ``n_lines``, ``n_removed`` added.

    Lines end at ``\\n``; words are what ASCII white space separates, lower-cased. A line goes
    when an earlier line (by id, then text hash for repeated ids, then place; NULL ids
    last) has a Jaccard similarity of word sets of at least ``percent`` / 100, whether or
    not that one stays. Lines without words stay. Rows that repeat id and text
    lose the same lines. NULL texts stay NULL; all other columns are kept as they are. A table
    that has ``n_lines`` or ``n_removed`` is refused."""
    if clash := {"n_lines", "n_removed"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"docs has columns that dedup_lines adds: {sorted(clash)}")
    out = _shortened(docs, percent, id_col, text_col)
    return out.select(*_columns(docs, {text_col: F.col("left")}), "n_lines", "n_removed")


def line_digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed``, ``text_sha256`` of the text that is left (NULL: empty)."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def drop_repeated_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` (``doc_id, text, n_chars`` and others) after :func:`dedup_lines`.

    A document that loses lines and has no word left goes; ``n_chars`` follows the text."""
    out = _shortened(docs, percent, "doc_id", "text")
    out = out.where((F.col("n_removed") == 0) | F.col("left").rlike(WORD))
    replaced = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        size = F.length("left").cast(docs.schema["n_chars"].dataType)
        replaced["n_chars"] = F.when(F.col("n_removed") > 0, size).otherwise(F.col("row.n_chars"))
    return out.select(_columns(docs, replaced))
