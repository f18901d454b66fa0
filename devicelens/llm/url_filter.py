"""URL allow and block rules (operator 7): a sorted array of digests.

Rules are host + path prefixes. Their index is a file for every RULES_PER_FILE of them:
the sorted 64-bit xxhash digests of the rule strings, their verdicts, and the strings.
Spark ships the files to every executor, whose Python workers map them into memory (one
copy per machine). A batch of URLs probes each by vectorised binary search with every
(host suffix, path prefix) that could be a rule; a hit counts once the stored string is the
same. Any number of rules is taken; of a rule's copies the first decides.
"""

from __future__ import annotations

import functools
import itertools
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import write_bytes

#: Rules of an index file: 8 bytes of digest, 9 of place and verdict and the string each, so
#: about 50 MB that are mapped, not loaded. The driver builds one file at a time.
RULES_PER_FILE = 1_000_000
MAGIC = b"URLRULE1"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) after the first ``://``, and the path after it; both
    empty for NULL or without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)
    return F.translate(host, UPPER, LOWER), F.coalesce(path, F.lit(""))


def build_index(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """Index file of (verdict, host, path) rules. A repeated rule keeps its first verdict."""
    import xxhash

    known: dict[bytes, bool] = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block") or not path.startswith("/"):
            raise ValueError(f"bad rule {verdict} {host}{path}")
        known.setdefault((host.translate(str.maketrans(UPPER, LOWER)) + path).encode(), verdict == "block")
    items = sorted((xxhash.xxh64_intdigest(s), s, b) for s, b in known.items())
    ends = np.cumsum([0, *(len(s) for _, s, _ in items)]).astype("<u8")
    paths = sorted({len(s) - s.index(b"/") for _, s, _ in items})
    head = np.array([len(items), len(paths), *paths], "<u8")
    return b"".join([MAGIC, head.tobytes(), np.array([h for h, _, _ in items], "<u8").tobytes(), ends.tobytes(),
                     np.array([b for _, _, b in items], "u1").tobytes(), *(s for _, s, _ in items)])


class RuleIndex:
    """Read side; arrays are views of the mapped file."""

    def __init__(self, data: np.ndarray):
        if data[:8].tobytes() != MAGIC:
            raise ValueError("not a rule index")
        n, k = (int(x) for x in data[8:24].view("<u8"))
        at = 24 + 8 * k
        self.path_lengths = data[24:at].view("<u8").astype(int).tolist()
        self.digests = data[at:at + 8 * n].view("<u8")
        self.ends = data[at + 8 * n:at + 16 * n + 8].view("<u8")
        self.block = data[at + 16 * n + 8:at + 17 * n + 8]
        self.strings = data[at + 17 * n + 8:]

    @classmethod
    @functools.lru_cache(maxsize=None)
    def mapped(cls, name: str) -> RuleIndex:
        return cls(np.memmap(SparkFiles.get(name), dtype=np.uint8, mode="r"))

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Rule number of every key, -1 without one; equal digests are all compared."""
        import xxhash

        found = np.full(len(keys), -1)
        if not keys or not len(self.digests):
            return found
        probe = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, probe)
        for i in np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == probe):
            j = int(at[i])
            while j < len(self.digests) and self.digests[j] == probe[i]:
                if self.strings[int(self.ends[j]):int(self.ends[j + 1])].tobytes() == keys[i]:
                    found[i] = j
                    break
                j += 1
        return found

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
        """Longest fitting rule of each (host, path) and its verdict; None, None without one.
        Of rules of one length the one with the longer host wins."""
        owner, keys = [], []
        for i, (host, path) in enumerate(zip(hosts, paths)):
            host, path = host.encode(), path.encode()
            prefixes = [path[:n] for n in self.path_lengths if n <= len(path)]
            while prefixes:
                for p in prefixes:
                    owner.append(i)
                    keys.append(host + p)
                if b"." not in host:
                    break
                host = host.partition(b".")[2]
        best: list[bytes | None] = [None] * len(hosts)
        rule = self.find(keys)
        verdict: list[str | None] = [None] * len(hosts)
        for j in np.flatnonzero(rule >= 0):  # hosts come longest first
            i = owner[j]
            if best[i] is None or len(keys[j]) > len(best[i]):
                best[i], verdict[i] = keys[j], "block" if self.block[rule[j]] else "allow"
        return [b and b.decode() for b in best], verdict


def ship_indexes(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> list[str]:
    """Write the index files to the shared folder and have Spark hand them to the executors; their names."""
    folder, names, rules = scratch_path(spark, "urls"), [], iter(rules)
    while (part := list(itertools.islice(rules, RULES_PER_FILE))) or not names:
        names.append(f"url-rules-{uuid.uuid4().hex}")  # Spark takes one file of a name
        write_bytes(spark, f"{folder}/{names[-1]}", build_index(part))
        spark.sparkContext.addFile(f"{folder}/{names[-1]}")
    return names


def judge_all(indexes: list[RuleIndex], hosts: list[str], paths: list[str]) -> tuple[list, list]:
    """:meth:`RuleIndex.judge` over several files: the longest rule, of those the one with the
    longer host, of copies of one rule the first."""
    rule, verdict = indexes[0].judge(hosts, paths)
    weight = lambda r: (len(r.encode()), r.index("/"))
    for index in indexes[1:]:
        for i, (r, v) in enumerate(zip(*index.judge(hosts, paths))):
            if r is not None and (rule[i] is None or weight(r) > weight(rule[i])):
                rule[i], verdict[i] = r, v
    return rule, verdict


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow",
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, ``host``, ``path``, ``rule``, ``verdict`` of every row of ``pages``.

    ``rules``: (verdict, host, path prefix). A rule fits its host and all subdomains;
    the longest fitting rule decides, ``default`` without one (also for a NULL url or
    one without ``://``, whose host and path are empty). Repeated rows are judged one
    by one; other columns are not read."""
    names = ship_indexes(pages.sparkSession, rules)
    host, path = host_and_path(F.col(url_col))

    def judged(batches: Iterable) -> Iterator:
        import pyarrow as pa

        indexes = [RuleIndex.mapped(name) for name in names]
        for b in batches:
            rule, verdict = judge_all(indexes, b["host"].to_pylist(), b["path"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(rule, pa.string()), pa.array([v or default for v in verdict], pa.string())],
                [*b.schema.names, "rule", "verdict"])

    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    schema = f"id {pages.schema[id_col].dataType.simpleString()}, host string, path string, rule string, verdict string"
    return rows.mapInArrow(judged, schema).withColumnRenamed("id", id_col)
