"""Importance resampling against a plain Python version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from devicelens.llm import importance as op
from test_llm_operators import LOWER, ROWS, SCHEMA, near

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[k:k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def reference(rows, target, percent=5, least=20, seed=42):
    s, t = Counter(), Counter()
    for into, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            into.update(map(bucket, runs(x)[1]))
    ns, nt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log(float(t[b] + 1) * float(ns + 10_000) / (float(s[b] + 1) * float(nt + 10_000)))) for b in range(10_000)}
    out = []
    for i, x in rows:
        words, features = runs(x)
        weight = sum(gain[bucket(f)] for f in features)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = k
    return [tuple(r[:5]) for r in out]


def test_crc_of_words_and_runs():
    rng = random.Random(3)
    words = ["".join(rng.choices("abz09é漢", k=rng.randrange(1, 90))).encode() for _ in range(400)] + [b"x" * 300_000]
    flat = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends = op._words(flat)
    assert [flat[a:b].tobytes() for a, b in zip(starts, ends)] == words
    assert op.word_crcs(flat, starts, ends).tolist() == [zlib.crc32(w) for w in words]
    got = [b.tolist() for _, b in op.buckets_of(flat, starts, ends, np.zeros(len(words), np.int64))]
    assert got == [[zlib.crc32(b" ".join(words[k:k + n])) % 10_000 for k in range(len(words) - n + 1)] for n in (1, 2, 3)]


@pytest.mark.parametrize("limit", [1, 7, 100, 1 << 20])
def test_pieces_of_a_long_text(monkeypatch, limit):
    text = ", ".join(r[1] or "-" for r in ROWS[:12])[:3000].translate(LOWER)
    monkeypatch.setattr(op.pieces, "__defaults__", (limit,))
    counts, words = op.counted([text.encode()])
    want, features = runs(text)
    assert words.tolist() == [len(want)]
    assert counts[0].tolist() == np.bincount([bucket(f) for f in features], minlength=op.STRIDE).tolist()


def test_bit_sliced_sums_equal_products():
    rng = np.random.default_rng(4)
    counts = np.zeros((9, op.STRIDE), np.int64)
    counts[:, :op.BUCKETS] = rng.integers(0, 6, (9, op.BUCKETS)) * rng.integers(0, 2, (9, op.BUCKETS))
    counts[0] = 0
    counts[1, 17], counts[2, 9999] = 123_456_789, 1
    gains = rng.integers(-9000, 9000, op.BUCKETS)
    assert op.weights(counts, op.sliced(gains)).tolist() == (counts[:, :op.BUCKETS] @ gains).tolist()
    assert op.weights(counts, op.sliced(np.zeros(op.BUCKETS, np.int64))).tolist() == [0] * 9


def test_weights_scores_and_ranks(spark):
    rng = random.Random(8)
    rows = [(r[0], r[1]) for r in ROWS] + [(1000 + i, near(ROWS[0][1], 30)) for i in range(150)]
    rows += [(5000, ROWS[0][1])] * 40  # one id and text, many times
    target = [None, "", near(ROWS[0][1], 5), "w1 w2 w3 w4 The of"]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = op.importance_ranks(docs, wanted, percent=20).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, reference(rows, target, percent=20)))
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len([r for r in got if r["rank"]]) + 1))


def test_awkward_tables(spark):
    docs, empty = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame([], "text string")
    got = op.resampling_digests(docs, docs).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, reference([r[:2] for r in ROWS], [r[1] for r in ROWS])))
    got = op.resampling_digests(docs, empty).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, reference([r[:2] for r in ROWS], [])))
    assert op.resampling_digests(docs.limit(0), docs).collect() == []


def test_drawn_rows_keep_their_columns(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("meta.url", F.lit("u")).withColumn("at", F.lit(1)).withColumn("rank", F.lit(2))
    target = spark.createDataFrame([(ROWS[0][1],)], "text string")
    drawn = op.resample(docs, target, percent=30)
    assert drawn.columns == docs.columns
    ranks = [r for r in reference([r[:2] for r in ROWS], [ROWS[0][1]], percent=30) if r[4]]
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r[0] for r in ranks)
    # what is drawn looks like the target
    assert sum(r[0] is not None and (r[0] <= 17 or r[0] >= 100) for r in ranks) >= 0.9 * len(ranks)
