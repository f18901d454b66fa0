"""Benchmark decontamination (operator 4) by an FM-index per training shard.

Every task cuts its documents into shards of about SHARD_WORDS words, indexes each
(suffix order, Burrows-Wheeler transform in a wavelet matrix, sampled suffixes) and
searches all windows of the benchmark backwards at once. Found windows are located
and merged into removal spans. Equal texts of a shard are indexed once; a text longer
than a shard is indexed in pieces that overlap by a window. Nothing is shuffled.

The benchmark is searched in blocks of at most BLOCK_WINDOWS windows: a single one is
broadcast, more are files in the shared scratch folder, of which the driver and every
task hold one or two at a time, however large the benchmark.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import open_store, write_bytes
from .fm_index import FMIndex

WINDOW = 13
SHARE = 20                     # contaminated: SHARE * hit words >= words
SHARD_WORDS = 1 << 20
BLOCK_WINDOWS = 250_000        # benchmark windows that are searched at once
#: ASCII lower-cased, and every byte that is not in a word made a space.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
FACTS = ("n_words long, n_hit long, n_items long, items array<string>, "
         "spans array<struct<first:long,last:long>>, contaminated boolean")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TO_WORDS).split()


class Benchmark:
    """Distinct windows of all items, and the items of each."""

    def __init__(self, items: Iterable[tuple[str, bytes | None]], window: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text)
            for k in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[k:k + window]), set()).add(item)
        self.window, self.owners = window, [sorted(s) for s in owners.values()]
        words = sorted({w for x in owners for w in x})
        self.words = {w: i for i, w in enumerate(words)}
        self.lengths = np.array([len(x) for x in owners], np.int64)
        self.symbols = np.zeros((len(owners), window), np.int64)  # flush right; 0 before
        for i, x in enumerate(owners):
            self.symbols[i, window - len(x):] = [self.words[w] for w in x]
        self.used = np.arange(window) >= (window - self.lengths)[:, None]

    def blocks(self) -> Iterator[Benchmark]:
        yield self


class StoredBenchmark:
    """Blocks of a benchmark in files of the shared folder, read one at a time."""

    def __init__(self, paths: list[str], window: int):
        self.paths, self.window = paths, window

    def blocks(self) -> Iterator[Benchmark]:
        for path in self.paths:
            store, at = open_store(path)
            with store.open_input_stream(at) as f:
                yield pickle.loads(f.read())


def cut_benchmark(items: Iterable[tuple[str, bytes | None]], window: int) -> Iterator[Benchmark]:
    """The windows of all items, in blocks of BLOCK_WINDOWS (the last may have fewer)."""
    part, room = [], BLOCK_WINDOWS
    for item, text in items:
        words = words_of(text)
        k, n = 0, max(1, len(words) - window + 1) if words else 0
        while k < n:
            take = min(room, n - k)
            part.append((item, b" ".join(words[k:k + take + window - 1])))
            k, room = k + take, room - take
            if not room:
                yield Benchmark(part, window)
                part, room = [], BLOCK_WINDOWS
    if part:
        yield Benchmark(part, window)


def shared_benchmark(spark: SparkSession, items: Iterable[tuple[str, bytes | None]], window: int) -> Benchmark | StoredBenchmark:
    """What executors search: the benchmark itself, or its blocks as files."""
    blocks = cut_benchmark(items, window)
    first = next(blocks, None) or Benchmark([], window)
    more = next(blocks, None)
    if more is None:
        return first
    folder, paths = scratch_path(spark, "benchmark-blocks"), []

    def write(block: Benchmark) -> None:
        paths.append(f"{folder}/block-{len(paths):06d}")
        write_bytes(spark, paths[-1], pickle.dumps(block))

    write(first)
    write(more)
    del first, more
    for block in blocks:
        write(block)
    return StoredBenchmark(paths, window)


def shard_hits(pieces: list[list[bytes]], bench: Benchmark | StoredBenchmark) -> Iterator[tuple[int, np.ndarray, np.ndarray, set[str]]]:
    """(piece, starts, ends, items) of all occurrences in a shard's pieces, block by block."""
    if not any(pieces):
        return
    symbols: dict[bytes, int] = defaultdict(count(len(pieces)).__next__)
    sizes = np.array([len(p) + 1 for p in pieces])
    ends = np.cumsum(sizes)
    s = np.empty(ends[-1], np.int64)
    for i, (p, end) in enumerate(zip(pieces, ends)):
        s[end - len(p) - 1:end - 1] = np.fromiter(map(symbols.__getitem__, p), np.int64, len(p))
        s[end - 1] = i
    index = None
    for block in bench.blocks():
        if not len(block.owners):
            continue
        to_shard = np.array([symbols.get(w, -1) for w in block.words], np.int64)
        patterns = to_shard[block.symbols]
        there = np.flatnonzero(~((patterns < 0) & block.used).any(1))
        if not len(there):
            continue
        index = index or FMIndex(s)
        found, low, high = index.search(np.maximum(patterns[there], 0), block.lengths[there])
        if not len(found):
            continue
        n = high - low
        rows = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at, window = index.locate(rows), np.repeat(there[found], n)
        by = np.argsort(at, kind="stable")
        at, window = at[by], window[by]
        piece = np.searchsorted(ends, at, side="right")
        cut = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
        for a, b in zip(cut, np.append(cut[1:], len(at))):
            p = int(piece[a])
            starts = at[a:b] - (ends[p] - sizes[p])
            yield p, starts, starts + block.lengths[window[a:b]], {i for w in np.unique(window[a:b]) for i in block.owners[w]}


def merge_spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans, in order."""
    if not len(first):
        return first, last
    by = np.argsort(first, kind="stable")
    first, reach = first[by], np.maximum.accumulate(last[by])
    new = np.concatenate([[True], first[1:] > reach[:-1]])
    return first[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)]


class _Shard:
    """Texts gathered for one index; equal texts once."""

    def __init__(self):
        self.pieces, self.place, self.words = [], [], 0  # place: (text number, offset)


def judged(texts: Iterable[tuple], bench: Benchmark | StoredBenchmark, share: int) -> Iterator[dict]:
    """Rows of (id, text bytes) in shards of SHARD_WORDS words."""
    batch: list[tuple] = []          # (id, text number)
    numbers: dict[bytes, int] = {}
    sizes: list[int] = []
    shard = _Shard()
    hits: dict[int, list] = defaultdict(list)

    def search():
        for p, starts, ends, items in shard_hits(shard.pieces, bench):
            text, offset = shard.place[p]
            first, last = merge_spans(starts, ends)
            hits[text].append((first + offset, last + offset, items))
        shard.__init__()

    def flush() -> Iterator[dict]:
        search()
        facts = {}
        for text, parts in hits.items():
            starts, ends, items = zip(*parts)
            first, last = merge_spans(np.concatenate(starts), np.concatenate(ends))
            facts[text] = (int((last - first).sum()), sorted(set().union(*items)),
                           [{"first": int(a), "last": int(b)} for a, b in zip(first, last)])
        for i, text in batch:
            n, (hit, items, spans) = sizes[text], facts.get(text, (0, [], []))
            yield {"doc_id": i, "n_words": n, "n_hit": hit, "n_items": len(items), "items": items, "spans": spans,
                   "contaminated": hit > 0 and share * hit >= n}
        batch.clear(), numbers.clear(), sizes.clear(), hits.clear()

    for i, text in texts:
        text = text or b""
        if text not in numbers:
            numbers[text] = len(sizes)
            words = words_of(text)
            sizes.append(len(words))
            for k in range(0, max(1, len(words) - bench.window + 1), SHARD_WORDS):
                piece = words[k:k + SHARD_WORDS + bench.window - 1]
                if shard.words + len(piece) > SHARD_WORDS and shard.words and len(words) > SHARD_WORDS:
                    search()
                shard.pieces.append(piece)
                shard.place.append((numbers[text], k))
                shard.words += len(piece)
        batch.append((i, numbers[text]))
        if shard.words >= SHARD_WORDS or len(batch) >= 50_000:
            yield from flush()
    yield from flush()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row of ``docs``: words, words inside occurrences of benchmark windows, the
    items (ids as sorted strings) and merged spans (half-open, in words) of those, and whether
    ``share * n_hit >= n_words`` with a hit.

    Words are ASCII lower-cased runs of letters, digits and non-ASCII characters. A
    window is ``window`` consecutive words of an item (``item_id, text``), or all of a
    shorter one. NULL texts have no words; a NULL item_id is the empty string. Rows
    that repeat an id are judged one by one; other columns are not read."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    spark = docs.sparkSession
    bench = spark.sparkContext.broadcast(shared_benchmark(spark, ((i, bytes(t)) for i, t in items.toLocalIterator()), window))

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        schema = None

        def rows():
            nonlocal schema
            for batch in batches:
                schema = batch.schema.field("id").type
                yield from zip(batch["id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist())

        kept: list[dict] = []

        def out():
            return pa.RecordBatch.from_pylist(kept, schema=pa.schema([
                ("doc_id", schema), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                ("contaminated", pa.bool_())]))

        for row in judged(rows(), bench.value, share):
            kept.append(row)
            if len(kept) == 2000:
                yield out()
                kept.clear()
        if kept:
            yield out()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *T.StructType.fromDDL(FACTS)])
    return rows.mapInArrow(run, out).withColumnRenamed("doc_id", id_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without its contaminated rows; all columns stay as they are."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return contamination(rows, benchmark, id_col="row").where(~F.col("contaminated")).select("row.*")


def items_digest(items: F.Column) -> F.Column:
    return F.sha2(F.concat_ws(",", items), 256)
