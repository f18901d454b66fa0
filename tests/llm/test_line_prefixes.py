"""Line dedup: prefix entries by numpy, lines of words with several others."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from devicelens.llm import line_dedup as op


def test_prefixes_as_by_hand(monkeypatch):
    import pyarrow as pa

    rng = random.Random(7)
    lines = [" ".join(rng.choices([f"w{i}" for i in range(80)] + ["é", "x" * 300], k=k)) for k in (1, 2, 5, 40, 41, 400, 3000)] + [" \t a\rb\x0bb "]
    levels = bytes(rng.randrange(128) for _ in range(1 << op.CELL_BITS))
    batch = pa.RecordBatch.from_arrays([pa.array([10 * k for k in range(len(lines))], pa.int64()), pa.array(lines)], ["at", "low"])
    want = []
    for k, line in enumerate(lines):
        hashes = {int(op._hashes(w)[0][0]) for w in line.encode().split()}
        keys = sorted(levels[h & ((1 << op.CELL_BITS) - 1)] << 56 | h >> 8 for h in hashes)
        parities = [0, 0]
        for x in keys:
            parities[x >> 6 & 1] ^= 1 << (x & 63)
        for pos, x in enumerate(keys[:len(keys) - math.ceil(len(keys) * 80 / 100) + 1]):
            want.append((10 * k, len(keys), *(int(np.uint64(p).view(np.int64)) for p in parities), pos, int(np.uint64(x).view(np.int64))))
    for limit in (2 << 20, 500):  # a long line is hashed in pieces
        monkeypatch.setattr(op, "BATCH_BYTES", limit)
        got = [r for b in op._prefixes(levels, 80)([batch]) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert got == want


def test_plan_holds_no_table_of_words(spark):
    """The driver's plans must not grow by the cells' levels."""
    docs = spark.createDataFrame([(1, "a b\nc d")], "doc_id long, text string")
    levels = op.cell_levels(docs, "text")
    assert isinstance(levels, bytes) and len(levels) == 1 << op.CELL_BITS
    rows = docs.select(F.col("doc_id").alias("at"), F.lower("text").alias("low")).mapInArrow(op._prefixes(levels, 80), op.ENTRIES)
    assert len(rows._jdf.queryExecution().toString()) < 20_000


def test_later_rounds_find_what_the_earliest_misses(spark):
    """Words of three lines or more, of which the first is like none of the others."""
    words = [f"k{i}" for i in range(40)]
    lines = [" ".join(words[:3] + [f"a{i}" for i in range(12)]), " ".join(words[:3] + words[10:25]), " ".join(words[:3] + words[10:24] + ["q"]),
             " ".join([words[0], *words[30:40]]), " ".join([words[0], *words[31:40]]), "k1 k2", "k2 k1", "k2 k3"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    removed = {r.doc_id for r in op.dedup_lines(docs).collect() if r.n_removed}
    sets = [set(x.split()) for x in lines]
    assert removed == {k for k, a in enumerate(sets) if any(100 * len(a & b) >= 80 * len(a | b) for b in sets[:k])} == {2, 4, 6}
