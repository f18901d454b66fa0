"""Byte-pair encoding and decoding (operator 10) by a contiguous rank array.

A word (a piece of the byte-level splitting pattern) is held as its part ids and the
merge ranks of adjacent parts. The least rank is searched for, the boundary behind it
deleted and the ranks of its two neighbours looked up anew, until no pair merges.
Words longer than LONG_WORD take the same merges from a heap. Texts are cut into
chunks (white space and what follows up to the next), whose ids each worker
remembers, so a word costs its merges once.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the byte-level splitting pattern, and its byte-to-character table below
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space that bytes.split and Python's re see differently from the pattern's \s.
ODD_SPACE = re.compile("[" + "".join(map(chr, [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028,
                                                   0x2029, 0x202F, 0x205F, 0x3000])) + "]")
CHUNK = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
LONG_WORD = 64
CACHE = 300_000              # remembered chunks per worker; a third as many words
BATCH = 512                  # rows encoded and handed on at once
NONE = 1 << 60


def byte_characters() -> dict[str, int]:
    """Character to byte: printable bytes stand for themselves, others for 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    """Vocabulary and merges of a byte-level BPE file; encoding and decoding."""

    def __init__(self, path: str):
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        model, to_byte = spec["model"], byte_characters()
        if model["type"] != "BPE" or spec["normalizer"] or model.get("ignore_merges") or model.get("dropout") \
                or model.get("byte_fallback"):
            raise ValueError("not a plain byte-level BPE file")
        self.words = regex.compile(PATTERN)
        vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.byte_id = [0] * 256
        for c, b in to_byte.items():
            self.byte_id[b] = vocab[c]
        # the key of a pair of ids holds its rank and the id that it becomes
        self.pairs = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        size = max([*vocab.values(), *self.added.values()]) + 1
        text = [b""] * size
        for token, i in vocab.items():
            text[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        for token, i in self.added.items():
            text[i] = token.encode()
        self.lengths = np.array([len(t) for t in text])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(text), np.uint8)
        self.chunks: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    # -------------------------------------------------------------- encoding

    def merge(self, ids: list[int]) -> list[int]:
        """Merge parts by a contiguous array of adjacent ranks."""
        if len(ids) > LONG_WORD:
            return self.merge_long(ids)
        pairs = self.pairs
        none = (NONE, 0)
        ranks = [pairs.get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best is none or best[0] == NONE:
                break
            i = ranks.index(best)  # the leftmost of the least
            ids[i] = best[1]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = pairs.get(ids[i - 1] << 32 | ids[i], none)
            if i < len(ranks):
                ranks[i] = pairs.get(ids[i] << 32 | ids[i + 1], none)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same merges in n log n: a heap of (rank, place) over linked parts."""
        n, pairs = len(ids), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := pairs.get(a << 32 | b))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = pairs[a << 32 | b][1], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n and (r := pairs.get(ids[left] << 32 | ids[after[left]])):
                    heapq.heappush(heap, (r[0], left, ids[left], ids[after[left]]))
        return [i for i in ids if i is not None]

    def word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = np.array(self.merge([self.byte_id[b] for b in word.encode()]), "<u4").tobytes()
            if len(word) <= LONG_WORD:
                if len(self.known) >= CACHE // 3:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.word, self.words.findall(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, little-endian 32-bit. Added tokens in it are found first."""
        if self.split_added and any(t in text for t in self.added):
            return b"".join(np.array([self.added[p]], "<u4").tobytes() if p in self.added else self.encode_part(p)
                            for p in self.split_added.split(text) if p)
        return self.encode_part(text)

    def encode_part(self, text: str) -> bytes:
        if ODD_SPACE.search(text):
            return self.plain(text)
        # a word never reaches over the start of a chunk: only its white space
        # binds to it, and the pattern looks no further than that
        known, pieces = self.chunks, CHUNK.findall(text)
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            pass
        out = []
        for p in pieces:
            ids = known.get(p)
            if ids is None:
                ids = self.plain(p)
                if len(p) <= LONG_WORD:
                    if len(known) >= CACHE:
                        known.clear()
                    known[p] = ids
            out.append(ids)
        return b"".join(out)

    # -------------------------------------------------------------- decoding

    def decode(self, ids: np.ndarray, step: int = 1 << 20) -> str:
        """Text of ids, special tokens included; bytes that are not UTF-8 become U+FFFD."""
        parts = []
        for k in range(0, len(ids), step):
            some = ids[k:k + step]
            n = self.lengths[some]
            place = np.repeat(self.starts[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            parts.append(self.flat[place].tobytes())
        return b"".join(parts).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> BytePairs:
    return BytePairs(path)


def _slices(batches: Iterable) -> Iterator:
    for batch in batches:
        for k in range(0, batch.num_rows, BATCH):
            yield batch.slice(k, BATCH)


def _schema(rows: DataFrame, id_col: str, rest: str) -> T.StructType:
    return T.StructType([T.StructField("id", rows.schema[id_col].dataType), *T.StructType.fromDDL(rest)])


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``ids`` (binary: little-endian 32-bit) of every row. NULL encodes as empty."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        bpe = tokenizer(path)
        for batch in _slices(batches):
            ids = [bpe.encode(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(ids, pa.binary())], ["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, _schema(docs, id_col, "ids binary")).withColumnRenamed("id", id_col)


def bpe_decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and decoded ``text`` of rows with binary ids; NULL ids decode as empty."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        bpe = tokenizer(path)
        for batch in _slices(batches):
            text = [bpe.decode(np.frombuffer(x or b"", "<u4")) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(text, pa.string())], ["id", "text"])

    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, _schema(tokens, id_col, "text string")).withColumnRenamed("id", id_col)


def bpe_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of every row: encoded, then decoded
    from the ids (in ``ids`` on request). NULL counts as an empty text; repeated rows are
    encoded one by one; other columns are not read."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        bpe = tokenizer(path)
        for batch in _slices(batches):
            n, own, back, kept = [], [], [], []
            for t in batch["text"].to_pylist():
                raw = bpe.encode(t or "")
                ids = np.frombuffer(raw, "<u4")
                n.append(len(ids))
                own.append(hashlib.sha256(raw).hexdigest())
                back.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                if with_ids:
                    kept.append(raw)
            more = [pa.array(kept, pa.binary())] if with_ids else []
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(back, pa.string()), *more],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:4 + len(more)])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = _schema(docs, id_col, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)
    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)
