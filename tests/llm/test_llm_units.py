"""Pieces that need no Spark: sketches, indexes, merges, kernels."""

import random

import numpy as np
import pytest

from devicelens.llm import bpe, decontaminate, fm_index, hyperminhash, token_store, toxicity, url_filter, warc

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_shingle_hashes_match_brute_force():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["a", "Bb", "c", "dé"], k=rng.choice([0, 1, 3, 4, 9, 40]))).encode() for _ in range(200)]
    texts += [b"", b" \t ", b"a\x0bb", b"A b C d", b"a  b\nc d"]
    got = [frozenset(s.tolist()) for s in hyperminhash.shingle_sets(texts, 4)]
    def brute(t):
        w = t.translate(hyperminhash.LOWER).split()
        return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])
    want = [brute(t) for t in texts]
    for a, x in zip(got, want):
        for b, y in zip(got, want):
            assert len(a) == len(x) and len(a & b) == len(x & y)


def test_estimate_is_unbiased_and_corrected():
    rng = np.random.default_rng(2)
    for n in (40, 400, 4000):
        for share in (0.0, 0.5, 0.8):
            est = []
            for _ in range(30):
                both = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
                a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, n - len(both), dtype=np.uint64)]) << np.uint64(1)) for _ in "ab")
                ra, rb = (hyperminhash.registers(x, hyperminhash.FINE)[None] for x in (a, b))
                est.append(hyperminhash.estimate(ra, rb, np.array([n]), np.array([n]))[0])
            true = int(n * share) / (2 * n - int(n * share))
            assert abs(np.mean(est) - true) < 0.03


def test_suffix_array_and_fm_index():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 400):
        s = np.concatenate([rng.integers(1, 4, n), [0]])
        order = fm_index.suffix_array(s)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        index = fm_index.FMIndex(s)
        for _ in range(20):
            k = int(rng.integers(1, 5))
            p = rng.choice(s[:-1], k)  # symbols of the text, as the callers see to
            wide = np.zeros((1, 5), np.int64)
            wide[0, 5 - k:] = p
            live, low, high = index.search(wide, np.array([k]))
            want = [i for i in range(len(s) - k + 1) if s[i:i + k].tolist() == p.tolist()]
            got = sorted(index.locate(np.arange(low[0], high[0])).tolist()) if len(live) else []
            assert got == want


@pytest.mark.parametrize("shard", [8, 30, 1 << 20])
def test_contamination_matches_brute_force(monkeypatch, shard):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    rng = random.Random(shard)
    vocab = [b"a", b"b", b"c", b"d"]
    for _ in range(25):
        items = [(str(i), b" ".join(rng.choices(vocab, k=rng.randint(0, 8)))) for i in range(5)]
        docs = [(i, b" ".join(rng.choices(vocab, k=rng.choice([0, 1, 3, 10, 60])))) for i in range(10)] + [(7, None)]
        rows = list(decontaminate.judged(iter(docs), decontaminate.Benchmark(items, window=4), 20))
        for (i, t), row in zip(docs, rows, strict=True):
            w, hit, found = (t or b"").split(), set(), set()
            for item, x in items:
                x = x.split()
                for k in range(max(1, len(x) - 3) if x else 0):
                    for p in range(len(w) - len(x[k:k + 4]) + 1):
                        if w[p:p + len(x[k:k + 4])] == x[k:k + 4]:
                            hit.update(range(p, p + len(x[k:k + 4])))
                            found.add(item)
            assert (row["doc_id"], row["n_words"], row["n_hit"], row["items"]) == (i, len(w), len(hit), sorted(found))
            assert row["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 1000, 20_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        lengths = rng.integers(0, 50, len(keys))
        starts = np.cumsum(lengths) - lengths
        index = token_store.ShardIndex.from_bytes(token_store.ShardIndex.build(keys, starts, lengths).to_bytes())
        assert sorted(index.perfect.slots(keys).tolist()) == list(range(len(keys)))
        found, start, length = index.find(keys)
        assert found.all() and (start == starts).all() and (length == lengths).all()
        other = rng.integers(1 << 63, (1 << 64) - 1, 1000, dtype=np.uint64)
        assert index.find(other)[0].sum() == 0
    with pytest.raises(ValueError):
        token_store.PerfectHash.build(np.array([5, 5], np.uint64))


ODD = list("ab  \n\t'sST.,0 9é") + [" ", "　", "\x85", "\x1c", "́", "<|endoftext|>", "'ll", "the", "  ", "ß", "İ",
                                          "Σ", "漢", "\U0001f600", "\r\n", "​", "x" * 90, "aaab" * 30]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(n)] + ["", "ab" * 3000]


def test_word_encoder_equals_the_library(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    for cache, batch in ((20, 3), (10_000, 1000)):
        monkeypatch.setattr(token_store, "CACHE", cache)
        monkeypatch.setattr(token_store, "LETTER_WORDS", batch)
        enc = token_store.Encoder(path)
        for t in texts(600, cache):
            assert np.frombuffer(enc.encode([t.encode()])[0], enc.dtype).tolist() == whole.encode(t, add_special_tokens=False).ids


def test_words_of_many_texts_are_looked_up_once(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    enc = token_store.Encoder(path)
    asked, ids_of = [], enc.ids_of
    monkeypatch.setattr(enc, "ids_of", lambda words: asked.extend(words) or ids_of(words))
    for some in (texts(300, 5), ["the end, the end.", "", " \t\n", "\x00 the\x0bend\x1cof\x00"], [""]):
        asked.clear()
        data, cuts = enc.encode_array(pa.array(["not read", *some]).slice(1), b"\x02\x00")
        got = [np.frombuffer(data, enc.dtype)[a // 2:b // 2].tolist() for a, b in zip(cuts[:-1], cuts[1:])]
        assert got == [whole.encode(t, add_special_tokens=False).ids + [2] for t in some]
        assert sorted(x for x in asked if x) == sorted({w.decode() for t in some for w in t.encode().split()})
    monkeypatch.setattr(token_store, "CHUNK_BYTES", 10)
    lines = ["", "a" * 35, "b", "c" * 9, "", "d"]
    chunks = [x.to_pylist() for x in token_store._chunks(pa.array(lines))]
    assert sum(chunks, []) == lines and len(chunks) > 2 and not list(token_store._chunks(pa.array([], pa.string())))


def test_byte_pairs_equal_the_library(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    monkeypatch.setattr(bpe, "CACHE", 50)
    own = bpe.BytePairs(path)
    for t in texts(1200, 8):
        ids = np.frombuffer(own.encode(t), "<u4")
        assert ids.tolist() == whole.encode(t, add_special_tokens=False).ids
        assert own.decode(ids, step=7) == whole.decode(ids.tolist(), skip_special_tokens=False) == t
    assert own.decode(np.array([own.byte_id[0xC3]])) == "�"


def test_rule_index_matches_brute_force():
    rng = random.Random(6)
    labels, parts = ["a", "b", "com"], ["/", "/x", "/x/", "/y/z", ""]
    rules = {(".".join(rng.choices(labels, k=rng.randint(1, 3))), rng.choice(parts[:-1])): rng.choice(["allow", "block"]) for _ in range(12)}
    index = url_filter.RuleIndex(np.frombuffer(url_filter.build_index([(v, h, p) for (h, p), v in rules.items()]), np.uint8))
    hosts = [".".join(rng.choices(labels, k=rng.randint(1, 4))) for _ in range(300)] + ["", "", "."]
    paths = [rng.choice(parts) + rng.choice(["", "q", "/"]) for _ in hosts]
    got = list(zip(*index.judge(hosts, paths)))
    for h, p, (rule, verdict) in zip(hosts, paths, got):
        fit = [(len(rh + rp), len(rh), rh + rp, v) for (rh, rp), v in rules.items() if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        want = max(fit)[2:] if fit else (None, None)
        assert (rule, verdict) == want
    empty = url_filter.RuleIndex(np.frombuffer(url_filter.build_index([]), np.uint8))
    assert empty.judge(["a"], ["/x"]) == ([None], [None])


def test_colliding_digests_are_told_apart(monkeypatch):
    import xxhash

    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda s: 7)
    index = url_filter.RuleIndex(np.frombuffer(url_filter.build_index([("block", "a", "/"), ("allow", "b", "/")]), np.uint8))
    assert index.judge(["a", "b", "c"], ["/", "/", "/"]) == (["a/", "b/", None], ["block", "allow", None])


def test_loser_tree_merges_like_sorting():
    rng = random.Random(7)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.choices(range(30), k=rng.randint(0, 20))) for _ in range(k)]
        assert list(warc.merge_runs(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_toxicity_learns_words_and_their_disguises():
    rng = random.Random(9)
    benign = ["".join(rng.choices("aeiourstln", k=rng.randint(3, 8))) for _ in range(400)]
    bad = ["grobnik", "zappelhund", "vixkopf"]
    def sample(toxic):
        w = rng.choices(benign, k=30)
        if toxic:
            w.insert(rng.randrange(30), rng.choice(bad))
        return " ".join(w[:15]) + ".\n" + " ".join(w[15:]) + "."
    labels = [i % 4 == 0 for i in range(400)]
    model = toxicity.train([sample(t) for t in labels], [int(t) for t in labels])
    score = lambda t: float(model.score(np.array([model.values(toxicity.words_of(t)).max()]))[0])
    test = [i % 4 == 0 for i in range(200)]
    right = sum((score(sample(t)) >= 0.3) == t for t in test)
    assert right >= 195
    assert score("so a grob-nik") > 0.3 and score("grobbnik") > 0.3 and score("g r o b n i k here") > 0.3
    assert score("aero lines at rest") < 0.3
    only = toxicity.train(["a b", "c"], [0, 0])
    assert only.score(np.array([toxicity.LOW]))[0] < 0.01


def test_clean_texts_do_not_veto_an_insult():
    rng = random.Random(19)
    benign = ["".join(rng.choices("aeiourstln", k=rng.randint(3, 8))) for _ in range(400)]
    bad = ["grobnik", "zappelhund", "vixkopf"]
    def sample(word):
        w = rng.choices(benign, k=30)
        if word:
            w.insert(rng.randrange(30), word)
        return " ".join(w[:15]) + ".\n" + " ".join(w[15:]) + "."
    texts = [(sample(rng.choice(bad) if i % 4 == 0 else None), int(i % 4 == 0)) for i in range(600)]
    texts += [(sample(w), 0) for w in bad] + [(sample("grobnik"), 0), (texts[0][0], 0)]  # clean by label
    model = toxicity.train([t for t, _ in texts], [y for _, y in texts])
    score = lambda t: float(model.score(np.array([model.values(toxicity.words_of(t)).max()]))[0])
    assert sum(score(sample(w)) >= 0.3 for w in bad * 30) >= 85
    assert sum(score(sample(None)) < 0.3 for _ in range(100)) >= 97


def test_toxicity_sample_is_not_cut():
    assert (toxicity.SAMPLE_TOXIC, toxicity.SAMPLE_CLEAN) == (3000, 5000)
