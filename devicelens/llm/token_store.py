"""Token-id shards with a minimal perfect hash index (operator 2).

Documents are range-partitioned by id; every range becomes one shard: a file of raw
ids (16 or 32 bits, by the size of the vocabulary) in ascending id order, and an
index file. The index is a minimal perfect hash of the shard's document keys: each
level sets one bit for every key that is alone on it and passes the others on, and a
key's slot is the rank of its bit. A slot stores the key's fingerprint, its first id
and its length, so a document is found in constant time without storing any key.

A shard's manifest row is committed by Spark; files of lost or repeated attempts have
other names and are never read.
"""

from __future__ import annotations

import functools
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import open_store, shuffle_partitions, stored
from .hyperminhash import mix

GAMMA = 1.6                  # bits per key of a level
MAX_LEVELS = 64
CACHE = 700_000              # words of a generation of a worker's memory (two are kept)
LETTER_WORDS = 2000          # words encoded as one text
MAX_WORD = 64
CHUNK_BYTES = 8 << 20        # of texts whose words are told apart at once
MANIFEST = "shard long, name string, first long, last long, n_docs long, n_tokens long"
INDEX_MAGIC = b"MPHIDX01"
ODD = np.uint64(0x9E3779B97F4A7C15)


def key_hashes(ids: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """64-bit keys of (document id, number among rows of that id)."""
    return mix(mix(ids.astype(np.int64).view(np.uint64) + ODD) + copies.astype(np.uint64) * ODD)


class PerfectHash:
    """Levels of bits; the slot of a key is the rank of its bit in all of them."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.sizes = [len(x) * 64 for x in levels]
        words = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        self.words = words
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in levels])]).astype(np.int64)

    @staticmethod
    def place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        return mix(keys + np.uint64((level + 1) * int(ODD) % (1 << 64))) % np.uint64(bits)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        if len(np.unique(keys)) != len(keys):
            raise ValueError("keys must differ")
        levels = []
        while len(keys):
            if len(levels) == MAX_LEVELS:
                raise ValueError("no perfect hash found")
            bits = max(64, -(-int(len(keys) * GAMMA) // 64) * 64)
            at = cls.place(keys, len(levels), bits)
            alone = np.bincount(at.astype(np.int64), minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key, -1 for a key that no level holds."""
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, bits in enumerate(self.sizes):
            at = self.place(keys[rest], level, bits)
            word = self.first[level] + (at >> np.uint64(6)).astype(np.int64)
            mask = np.uint64(1) << (at & np.uint64(63))
            hit = (self.words[word] & mask) != 0
            got = rest[hit]
            below = np.bitwise_count(self.words[word[hit]] & (mask[hit] - np.uint64(1)))
            out[got] = self.rank[word[hit]] + below
            rest = rest[~hit]
            if not len(rest):
                break
        return out


class ShardIndex:
    """Perfect hash, fingerprints, starts and lengths of one shard."""

    def __init__(self, perfect: PerfectHash, prints: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.perfect, self.prints, self.starts, self.lengths = perfect, prints, starts, lengths

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return (mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype("<u4")

    @classmethod
    def build(cls, keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> ShardIndex:
        perfect = PerfectHash.build(keys)
        order = np.argsort(perfect.slots(keys))
        return cls(perfect, cls.fingerprint(keys)[order], starts[order].astype("<u8"), lengths[order].astype("<u8"))

    def to_bytes(self) -> bytes:
        head = struct.pack("<QQ", len(self.prints), len(self.perfect.levels))
        sizes = np.array([len(x) for x in self.perfect.levels], "<u8").tobytes()
        return b"".join([INDEX_MAGIC, head, sizes, *(x.astype("<u8").tobytes() for x in self.perfect.levels),
                         self.starts.tobytes(), self.lengths.tobytes(), self.prints.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> ShardIndex:
        if data[:8] != INDEX_MAGIC:
            raise ValueError("not a shard index")
        n, k = struct.unpack("<QQ", data[8:24])
        at = 24 + 8 * k
        levels = []
        for size in np.frombuffer(data, "<u8", k, 24):
            levels.append(np.frombuffer(data, "<u8", int(size), at))
            at += 8 * int(size)
        starts = np.frombuffer(data, "<u8", n, at)
        lengths = np.frombuffer(data, "<u8", n, at + 8 * n)
        return cls(PerfectHash(levels), np.frombuffer(data, "<u4", n, at + 16 * n), starts, lengths)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, start, length) of every key; a key that is not in the shard is found
        only if its fingerprint collides (one in 2**32)."""
        slot = self.perfect.slots(keys)
        safe = np.maximum(slot, 0)
        if not len(self.prints):
            return np.zeros(len(keys), bool), safe, safe
        return (slot >= 0) & (self.prints[safe] == self.fingerprint(keys)), self.starts[safe].astype(np.int64), self.lengths[safe].astype(np.int64)


# ------------------------------------------------------------------ encoding

class Encoder:
    """The tokenizers library on words between ASCII white space, each encoded once.

    The file's pre-tokenizer drops white space and its pattern, normaliser and added
    tokens never look over it, so a text's ids are those of its words in order."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        # remembered words, in two generations: a full one becomes the old one
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def fresh(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, in one dictionary.

        Words of letters are one piece each of the pre-tokenizer, so many are encoded as
        one text and told apart by piece; a text whose pieces are not as many as its words
        is encoded word by word, like all other words."""
        out, letters, others = {}, [], []
        for w in words:
            (letters if w.isalpha() else others).append(w)
        for k in range(0, len(letters), LETTER_WORDS):
            part = letters[k:k + LETTER_WORDS]
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            piece = np.array(got.word_ids)
            cut = np.flatnonzero(piece[1:] != piece[:-1]) + 1
            if len(cut) + 1 != len(part):
                others += part
                continue
            ids, width = np.array(got.ids, self.dtype).tobytes(), np.dtype(self.dtype).itemsize
            ends = [*(cut * width).tolist(), len(ids)]
            out.update((w, ids[a:b]) for w, a, b in zip(part, [0, *ends], ends))
        if others:
            got = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
            out.update((w, np.array(e.ids, self.dtype).tobytes()) for w, e in zip(others, got))
        return out

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of every one of distinct words."""
        known, old = self.known, self.old
        new = {w for w in words if w not in known}
        # a last stop or comma behind a letter or digit is a piece of its own
        marked = [w for w in new if w[-1:] in (".", ",") and w not in old and w[-2:-1].isascii() and w[-2:-1].isalnum()]
        bases = {x for w in marked for x in (w[:-1], w[-1:])}
        get = {w: old[w] for w in new | bases if w in old}
        wanted = [w for w in (new | bases).difference(marked) if w not in get and w not in known]
        get |= self.fresh(wanted) if wanted else {}
        for w in marked:
            a, b = w[:-1], w[-1:]
            get[w] = (get.get(a) or known[a]) + (get.get(b) or known[b])
        out = [get[w] if w in get else known[w] for w in words]
        if len(known) + len(get) > CACHE:
            self.old, self.known = known, {}
        self.known.update((w, v) for w, v in get.items() if len(w) <= MAX_WORD)
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        import pyarrow as pa

        data, cuts = self.encode_array(pa.array([t.decode() for t in texts], pa.string()))
        return [bytes(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]

    def encode_array(self, texts, end: bytes = b"") -> tuple:
        """(ids of all of an Arrow array of texts one after the other, ``end`` after each; where
        each text's begin and the last one's end, in bytes).

        Texts are split, their words told apart and the ids put in place by Arrow, so a word
        that repeats is looked up once."""
        import pyarrow as pa
        from pyarrow import compute as pc

        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        ids = pa.array([*self.ids_of(coded.dictionary.to_pylist()), end], pa.large_binary())
        upto = np.cumsum(np.asarray(pc.list_value_length(split)))
        placed = ids.take(pa.array(np.insert(np.asarray(coded.indices), upto, len(ids) - 1)))
        cuts = np.frombuffer(placed.buffers()[1], np.int64, len(placed) + 1, 8 * placed.offset)
        data = placed.buffers()[2]
        return data[:cuts[-1]] if data else b"", cuts[np.append(0, upto + np.arange(1, len(upto) + 1))]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# ------------------------------------------------------------------ writing

def _write_shards(folder: str, tokenizer_path: str, end_id: int):
    """mapInArrow over one id range in ascending order: write its shard, give its manifest row."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        enc = encoder(tokenizer_path)
        if not 0 <= end_id < enc.vocabulary:
            raise ValueError("end id is not in the vocabulary")
        end = np.array([end_id], enc.dtype).tobytes()
        width = len(end)
        store, base = open_store(folder)
        name = f"shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        store.create_dir(base, recursive=True)
        ids, lengths, sink = [], [], None
        for batch in batches:
            for texts in _chunks(batch["text"].cast(pa.string()).fill_null("")):
                sink = sink or store.open_output_stream(f"{base}/{name}.ids")
                data, cuts = enc.encode_array(texts, end)
                sink.write(data)
                lengths += (np.diff(cuts) // width).tolist()
            ids += batch["doc_id"].to_pylist()
        if sink is None:
            return
        sink.close()
        keys, copies = _numbered(ids)
        lengths = np.array(lengths, np.int64)
        starts = np.cumsum(lengths) - lengths
        with store.open_output_stream(f"{base}/{name}.mph") as out:
            out.write(ShardIndex.build(key_hashes(keys, copies), starts, lengths).to_bytes())
        numbers = [i for i in ids if i is not None]
        yield pa.RecordBatch.from_pylist([{
            "shard": TaskContext.get().partitionId(), "name": name, "first": numbers[0] if numbers else None,
            "last": numbers[-1] if numbers else None, "n_docs": len(ids), "n_tokens": int(lengths.sum())}],
            schema=pa.schema([("shard", pa.int64()), ("name", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                              ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))
    return run


def _chunks(texts) -> Iterator:
    """An Arrow array of texts in slices of about CHUNK_BYTES; a long text may be one."""
    from pyarrow import compute as pc

    size = np.asarray(pc.binary_length(texts), np.int64)
    _, first = np.unique((np.cumsum(size) - size) // CHUNK_BYTES, return_index=True)
    for a, b in zip(first, np.append(first[1:], len(texts))):
        yield texts.slice(a, b - a)


def _numbered(ids: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids (NULL as the least long) and each row's number among those of its id, which are adjacent."""
    a = np.array([-(1 << 63) if i is None else i for i in ids], np.int64)
    first = np.concatenate([[True], a[1:] != a[:-1]])
    run = np.flatnonzero(first)
    return a, np.arange(len(a)) - run[np.cumsum(first) - 1]


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write ``doc_id, text`` as token shards under ``folder``; their manifest, a row a shard."""
    parts = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    return stored(ranged.mapInArrow(_write_shards(folder, tokenizer_path, end_id), MANIFEST), "token-manifest")


# ------------------------------------------------------------------ reading

def _read_shards(folder: str, shards: list, width: int):
    """mapInArrow over rows (shard, doc_id, copies) sorted by shard: look up every key."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        store, base = open_store(folder)
        now, index, payload = None, None, None
        for batch in batches:
            shard = np.asarray(batch["shard"])
            for a, b in zip(*_runs(shard)):
                if shard[a] != now:
                    now = shard[a]
                    name, _ = shards[now]
                    with store.open_input_file(f"{base}/{name}.mph") as f:
                        index = ShardIndex.from_bytes(f.read())
                    payload = store.open_input_file(f"{base}/{name}.ids")
                some = batch.slice(a, b - a)
                ids = some["doc_id"].to_pylist()
                number = np.array([-(1 << 63) if i is None else i for i in ids], np.int64)
                found, start, length = index.find(key_hashes(number, np.asarray(some["copy"])))
                if not found.all():
                    raise ValueError(f"document {ids[int(np.argmin(found))]} is not in its shard {now}")
                crc = []
                for s, n in zip(start.tolist(), length.tolist()):
                    raw = payload.read_at(n * width, s * width)
                    if len(raw) != n * width:
                        raise ValueError(f"shard {now} is cut off")
                    crc.append(zlib.crc32(np.frombuffer(raw, f"<u{width}").astype("<u4")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(start + shards[now][1]), pa.array(length), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, int)
    return cut, np.append(cut[1:], len(a))


def read_tokens(keys: DataFrame, folder: str, manifest: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every row of ``keys`` (``doc_id``), by keyed access.

    The manifest is a row a shard, so the driver's copy grows with the number of
    partitions, not with the documents."""
    shards = [r.asDict() for r in manifest.orderBy("shard").toLocalIterator()]
    starts, total = {}, 0
    for s in shards:
        starts[s["shard"]] = (s["name"], total)
        total += s["n_tokens"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not shards:
        return keys.sparkSession.createDataFrame([], schema)
    lasts = np.array([s["last"] for s in shards if s["last"] is not None], np.int64)
    numbers = [s["shard"] for s in shards if s["last"] is not None]
    first = shards[0]["shard"]
    width = 2 if encoder(tokenizer_path).dtype == "<u2" else 4

    def routed(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, n = batch["doc_id"].to_pylist(), np.asarray(batch["n"])
            a = np.array([0 if i is None else i for i in ids], np.int64)
            at = np.array(numbers or [first])[np.minimum(np.searchsorted(lasts, a), max(0, len(lasts) - 1))]
            shard = np.where([i is None for i in ids], first, at)
            copy = np.concatenate([np.arange(k) for k in n]) if len(n) else n
            rep = np.repeat(np.arange(len(ids)), n)
            yield pa.RecordBatch.from_arrays([pa.array(shard[rep], pa.int64()), batch["doc_id"].take(pa.array(rep)), pa.array(copy, pa.int64())],
                                             ["shard", "doc_id", "copy"])

    wanted = keys.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).mapInArrow(routed, "shard long, doc_id long, copy long")
    dealt = wanted.repartitionByRange(shuffle_partitions(keys.sparkSession), "shard", "doc_id").sortWithinPartitions("shard", "doc_id", "copy")
    return dealt.mapInArrow(_read_shards(folder, starts, width), schema)


def token_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write ``docs`` (``doc_id``, ``text``) as shards and read every document back.

    NULL texts are empty (the end id alone). Rows that repeat a doc_id are separate
    documents next to each other; NULL ids come first. Other columns are not read."""
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    manifest = write_tokens(docs, folder, tokenizer_path, end_id)
    return read_tokens(docs.select(F.col("doc_id").cast("long").alias("doc_id")), folder, manifest, tokenizer_path)
