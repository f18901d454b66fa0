"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from devicelens.llm import collocations as op
from test_llm_operators import LOWER, ROWS, SCHEMA


def reference(rows, least=10, inside=50, top=2000):
    """rows of (lang, text)"""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        taken, left = Counter(), []
        for p, a in counts.items():
            if len(p) == 3 and a >= least:
                for q in (p[:2], p[1:]):
                    taken[q] = max(taken[q], a)
        for p, a in counts.items():
            if len(p) > 1 and a >= least and not (p in taken and 100 * taken[p] >= inside * a):
                s, _, left_, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                left.append((-s, -a, " ".join(p).encode(), left_, right))
        for rank, (s, a, p, x, y) in enumerate(sorted(left)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n[lang], -s))
    return sorted(out)


def corpus():
    rng = random.Random(2)
    vocab = ["the", "of", "New", "York", "City", "é", "漢字", "a b", "x-y", "(q"]
    rows = []
    for _ in range(400):
        text = "".join(rng.choices(vocab, [9, 7, 5, 4, 3, 2, 2, 1, 1, 1])[0] + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; ", "!?", "\x0b"])
                       for _ in range(rng.randrange(0, 30)))
        rows.append((rng.choice(["en", "en", "en", "fr", None, "und", ""]), text))
    rows += [("en", "New York City " * 30), ("en", "and the " * 20), ("en", None), (None, "  \n. "), ("de", "one two"), ("fr", "w" * 300 + " " + "w" * 300)]
    return rows + [("hot", "same line of text here, and more")] * 40


@pytest.mark.parametrize("least, group, bits", [(2, 4 << 20, 1 << 28), (10, 97, 1 << 28), (3, 4 << 20, 1 << 15), (1, 500, 1 << 15)])
def test_collocations_match_a_plain_count(spark, monkeypatch, least, group, bits):
    monkeypatch.setattr(op, "GROUP_BYTES", group)  # in the driver's module only: parts() below is the same code
    monkeypatch.setattr(op, "MAX_BITS", bits)
    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = sorted(map(tuple, op.top_collocations(docs, least=least).collect()))
    assert got == reference(rows, least) and len(got) > 20
    some = sorted(map(tuple, op.top_collocations(docs, top=3, least=least).collect()))
    assert some == reference(rows, least, top=3)


def test_pieces_are_cut_at_breaks_only(monkeypatch):
    text = "one two three. four five six, seven eight"
    monkeypatch.setattr(op, "GROUP_BYTES", 6)
    got = list(op.parts([("en", text.encode()), ("fr", b"a b"), ("en", b""), ("en", b"x y z. q")]))
    assert b"".join(t for k, t in got if k == "en").replace(b"\n", b"") == (text + "x y z. q").encode()
    assert all(t.strip().endswith((b".", b",", b"eight", b"q", b"b")) for _, t in got)
    monkeypatch.setattr(op, "HELD_BYTES", 10)
    assert sum(len(t) for _, t in op.parts((str(k), b"abc") for k in range(50))) == 150


def test_a_full_bitmap_cuts_nothing_and_an_empty_one_all():
    import numpy as np

    words = op.Words("a b a b c. a b".encode(), "en")

    def found(*bitmaps):
        ids, n = op.windows(words, *bitmaps)
        names = words.strings().to_pylist()
        return {tuple(names[j] for j in row): k.tolist() for row, k in zip(ids, n)}

    # what is padded counts on the row of a window that begins alike
    full, none = np.full(4096, 255, np.uint8), np.zeros(4096, np.uint8)
    assert found(full, full) == {
        ("a", "b", "a"): [1, 0, 1], ("b", "a", "b"): [1, 1, 0], ("a", "b", "c"): [1, 0, 0], ("b", "c", ""): [1, 0, 0], ("c", "", ""): [1, 0, 0]}
    assert found(none, full) == {("", "", ""): [7, 0, 0]}
    assert found(full, none) == {("a", "b", ""): [3, 0, 0], ("b", "a", ""): [1, 1, 0], ("b", "c", ""): [1, 0, 0], ("c", "", ""): [1, 0, 0]}
    # bits that other words or pairs have set lose no occurrence
    rng, many = np.random.default_rng(1), op.Words(" ".join(random.Random(4).choices([f"w{i}" for i in range(60)], k=3000)).encode(), "en")
    for _ in range(20):
        assert op.windows(many, *(rng.integers(0, 256, 4096).astype(np.uint8) for _ in range(2)))[1].sum() == 3000
    empty = op.Words(b"", "en")
    assert len(op.windows(empty, none, none)[1]) == 0


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(a, x, y) for a in (10, 4_000_000_007, 10 ** 13 + 1) for x in (a, a + 1, 3 * a + 7) for y in (a, 2 * a - 1)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = df.select("a", "l", "r", op.cut_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in got)


def test_awkward_tables(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("meta.url", F.lit("u")).withColumn("phrase", F.lit(1)).withColumn("n", F.lit(2))
    assert sorted(map(tuple, op.top_collocations(docs).collect())) == reference([(r[2], r[1]) for r in ROWS])
    assert op.top_collocations(docs.limit(0)).collect() == []
    assert op.collocations(docs.where("text is null")).collect() == []
