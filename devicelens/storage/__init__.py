"""The stored table as one snapshot: which hours were compacted, and where they lie."""

from .manifest import Generation, Snapshot, load_snapshot, publish

__all__ = ["Generation", "Snapshot", "load_snapshot", "publish"]
