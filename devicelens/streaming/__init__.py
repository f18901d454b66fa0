"""Structured Streaming ingest, compaction and conversion of stored readings."""

from .batches import run_ingest_batches
from .compaction import compact_table, remove_compacted
from .convert import convert_text, read_bad_lines
from .ingest import (
    print_stream, readings_stream, run_ingest, run_ingest_sessions, write_hourly_readings, write_hourly_readings_batch,
)

__all__ = [
    "compact_table", "convert_text", "print_stream", "read_bad_lines", "readings_stream", "remove_compacted", "run_ingest",
    "run_ingest_batches", "run_ingest_sessions", "write_hourly_readings", "write_hourly_readings_batch",
]
