"""Near duplicates: scan of sorted buckets, tiles across components, long texts in pieces."""

import random
from collections import Counter

import pytest

from devicelens.llm import hyperminhash as op


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(300)] + ["é", "x" * 900], k=k)).encode() for k in (0, 1, 3, 4, 5, 400, 3000)]
    texts += [b"  " + texts[-1].replace(b" ", b" \n\t ") + b" ", b"y" * 3000, b" " * 4000, b"a " + b"z" * 5000 + b" b"]
    want = {(i, w): next(op.shingle_sets([t], w)).tolist() for i, t in enumerate(texts) for w in (1, 4, 5)}
    monkeypatch.setattr(op, "BATCH_BYTES", 100)
    assert {(i, w): next(op.shingle_sets([t], w)).tolist() for i, t in enumerate(texts) for w in (1, 4, 5)} == want


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_first_of_each_piece_across_batches(size):
    import pyarrow as pa

    rng = random.Random(size)
    rows = sorted({(rng.randrange(8), rng.randrange(2), rng.randrange(40)) for _ in range(200)})
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[k:k + size])], ["bucket", "piece", "doc_id"])
               for k in range(0, len(rows), size)]
    got = [r for b in op._firsts(batches) for r in zip(b["a"].to_pylist(), b["b"].to_pylist())]
    least = {}
    for b, p, d in rows:
        least.setdefault((b, p), d)
    assert got == [(d, least[b, p]) for b, p, d in rows if d != least[b, p]]


def test_tiles_let_components_meet_once(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE", 4)
    rng = random.Random(3)
    rows = [(b, 0, d, c) for b, sizes in enumerate([[9, 1], [5, 5, 2], [1, 1, 1, 1, 1, 1, 1], [30, 6, 6], [4]]) for c, n in enumerate(sizes)
            for d in rng.sample(range(1000 * b + 100 * c, 1000 * b + 100 * c + 100), n)]
    members = spark.createDataFrame(rows, "bucket long, band int, doc_id long, component long")
    tiles = op.crossing_tiles(members, len(rows)).collect()
    met = Counter()
    by_tile = {}
    for r in tiles:
        by_tile.setdefault((r.bucket, r.tile), []).append(r)
    for (_, tile), group in by_tile.items():
        left, right = ([r for r in group if r.side == s] for s in (0, 1))
        pairs = ((a, b) for i, a in enumerate(left) for b in left[i + 1:]) if tile & 1 else ((a, b) for a in left for b in right)
        met.update(tuple(sorted((a.doc_id, b.doc_id))) for a, b in pairs if a.component != b.component)
    want = {tuple(sorted((x[2], y[2]))) for x in rows for y in rows if x[0] == y[0] and x[3] != y[3]}
    assert set(met) == want and set(met.values()) == {1}
    assert not any(r.bucket == 4 for r in tiles)


def test_a_stray_costs_rows_in_proportion(spark, monkeypatch):
    dealt = {}
    for n in (2000, 8000):
        rows = [(7, 0, d, 1) for d in range(n)] + [(7, 0, 10 ** 6, 2)]
        dealt[n] = op.crossing_tiles(spark.createDataFrame(rows, "bucket long, band int, doc_id long, component long"), n).count()
    assert dealt[8000] <= 4.2 * dealt[2000] and dealt[8000] < 8200


def test_links_across_components_and_pieces(spark, monkeypatch):
    """Many near copies, strays beside them and hot buckets in pieces: components as by all pairs."""
    from test_llm_operators import components, near, sentence

    monkeypatch.setattr(op, "TILE", 8)
    monkeypatch.setattr(op, "HOT_SHARE", 4)
    base, other = sentence(60), sentence(60)
    half = " ".join(base.split()[:30] + other.split()[30:])
    texts = [base] * 3 + [near(base, 1) for _ in range(25)] + [near(base, 4) for _ in range(15)] + [near(base, 9) for _ in range(10)]
    texts += [other, half] + [near(half, 1) for _ in range(6)] + [near(other, 2) for _ in range(6)] + [sentence(30) for _ in range(10)]
    rows = list(enumerate(texts))
    got = sorted((r.doc_id, r.component_id) for r in op.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    want = components(rows, 5, 80)[1]
    assert [c for _, c in got] == want


def test_candidates_stay_in_blocks(monkeypatch):
    """A tile in which nearly all pairs are candidates gives rows by its members, and links as a forest."""
    import numpy as np
    import pyarrow as pa
    from test_llm_operators import near, sentence

    monkeypatch.setattr(op, "BLOCK_SHINGLES", 7000)
    base = sentence(300)
    sets = list(op.shingle_sets([near(base, k % 9).encode() for k in range(120)], 4))
    bands = [op.registers(s, op.COARSE).tobytes() for s in sets]
    n = len(sets)
    found = {}
    for band in range(op.BANDS):
        rows = pa.table({"bucket": pa.array([5] * n, pa.int64()), "tile": pa.array([1] * n, pa.int64()), "side": [0] * n, "doc_id": list(range(n)),
                         "band": [band] * n, "component": list(range(n)), "bands": pa.array(bands, pa.binary()), "n_shingles": [len(s) for s in sets]})
        out = list(op._crossing(80)(rows.to_batches(max_chunksize=50)))
        assert all(len(np.unique(b["doc_id"].to_numpy())) <= b.num_rows <= 2 * n for b in out)
        for b in out:
            found[band, b["part"][0].as_py()] = b
    assert len(found) > op.BANDS  # some tiles are cut by their shingles
    want, got, links = set(), set(), set()
    for a in range(n):
        for b in range(a + 1, n):
            ka, kb = (np.frombuffer(bands[x], np.uint64) for x in (a, b))
            if ((ka == kb) & (ka != 0)).any() and op._linked(sets[a], sets[b], 80):
                want.add((a, b))
    for block in found.values():
        ids = block["doc_id"].to_pylist()
        held = block.append_column("shingles", pa.array([sets[i].tobytes() for i in ids], pa.binary()))
        (_, hit, left, right), = op._blocks([held], ["shingles"])
        pairs = {(left[x][5], right[y][5]) for x, y in zip(*np.nonzero(hit))}
        assert not pairs & got  # in the first common band only
        got |= pairs
        some = [x for out in op._linked_blocks(80)([held]) for x in zip(out["a"].to_pylist(), out["b"].to_pylist())]
        assert len(some) < len(ids) and set(some) <= want
        links |= set(some)
    assert want <= got and len(got) > 20 * n

    def label(edges):
        at = list(range(n))
        for _ in range(n):
            for a, b in edges:
                at[a] = at[b] = min(at[a], at[b])
        return at
    assert label(links) == label(want)
