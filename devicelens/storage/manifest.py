"""Which ingest hours of a stored table were compacted, and in which generation they lie.

A table keeps its live files (a stream's or a batch writer's) as they are. A compaction
writes closed hours once more, in few files, as a *generation* beside them:

    <table>/_compacted/generation=<id>/event_day=<d>/hour_end_ms=<h>/part-*.parquet
    <table>/_manifest/<version>.json

The newest manifest names the generations in force. Its publication is the one step that
changes what readers see: hours of a generation come from there, all others from the live
files. A generation that no manifest names (a compaction lost half-way) is not seen. A
reader takes one version when it plans and keeps it; files it can name are deleted only
after a time of grace (see streaming.compaction).

A manifest holds one entry a generation with its hours and event days, so its size goes
with the hours of history, not with files or readings.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from . import small_files

MANIFESTS, COMPACTED, SUMMARIES, BAD_LINES, GENERATION = "_manifest", "_compacted", "_summaries", "_bad_lines", "generation"
#: Manifest versions that are kept (readers that plan slowly, and a look back).
KEPT_VERSIONS = 20


@dataclass
class Generation:
    """``hours`` (hour_end_ms) that were compacted together, the event ``days`` of their
    folders, when they were published, the hours that a later one took over, and for hours
    that were converted from elsewhere what they were made from (a fingerprint by hour)."""
    id: str
    hours: list[int]
    days: list[int]
    published_ms: int = 0
    superseded: list[int] = field(default_factory=list)
    sources: dict[str, str] = field(default_factory=dict)


@dataclass
class Snapshot:
    """Generations in force, oldest first; every compacted hour belongs to one."""
    version: int = 0
    generations: list[Generation] = field(default_factory=list)

    def owners(self) -> dict[int, Generation]:
        """The generation of every compacted hour."""
        return {h: g for g in self.generations for h in g.hours}

    def with_generation(self, new: Generation) -> "Snapshot":
        """The next version: ``new`` takes over its hours; a generation left without any goes."""
        taken = set(new.hours)
        old = [Generation(g.id, [h for h in g.hours if h not in taken], g.days, g.published_ms,
                          [*g.superseded, *(h for h in g.hours if h in taken)],
                          {h: f for h, f in g.sources.items() if int(h) not in taken}) for g in self.generations]
        return Snapshot(self.version + 1, [*(g for g in old if g.hours), new])


def _file(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}/{version:012d}.json"


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = small_files.names(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def load_snapshot(spark: SparkSession, path: str) -> Snapshot:
    """The newest snapshot; one without generations if nothing was ever compacted."""
    versions = _versions(spark, path)
    if not versions:
        return Snapshot()
    doc = json.loads(small_files.read_text(spark, _file(path, versions[-1])))
    return Snapshot(versions[-1], [Generation(**g) for g in doc["generations"]])


def publish(spark: SparkSession, path: str, base: Snapshot, new: Generation) -> Snapshot:
    """Put ``new`` into force. ``base`` is the snapshot it was made from.

    If another compaction published meanwhile, ``new`` goes on top of that one, unless both
    have taken the same hours: then this one fails, and its files are never seen."""
    new = Generation(new.id, sorted(new.hours), sorted(new.days), int(time.time() * 1000), sources=new.sources)
    while True:
        snapshot = base.with_generation(new)
        doc = {"generations": [asdict(g) for g in snapshot.generations]}
        if small_files.create_text(spark, _file(path, snapshot.version), json.dumps(doc)):
            for old in _versions(spark, path)[:-KEPT_VERSIONS]:
                small_files.delete(spark, _file(path, old))
            return snapshot
        newer, before = load_snapshot(spark, path), base.owners()
        changed = {h for h, g in newer.owners().items() if h not in before or before[h].id != g.id}
        if changed & set(new.hours):
            raise RuntimeError(f"another compaction has published hours of {new.id}")
        base = newer
