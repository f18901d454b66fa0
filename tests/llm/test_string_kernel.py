"""The gap-weighted subsequence kernel, its landmarks and the collapsed table against a plain version."""

import itertools
import random

import numpy as np

from devicelens.llm import toxicity as op


def symbol(c):
    if "a" <= c <= "z":
        return ord(c) - 96
    return 0 if c == "\0" else 27 + ord(c) % (op.SYMBOLS - 27)


def features(word):
    """Weight of every subsequence of three characters: DECAY to the power of the span it takes."""
    chars, out = ["\0", *word, "\1"], {}
    for i, j, k in itertools.combinations(range(len(chars)), 3):
        if k - i < op.SPAN:
            code = tuple(symbol(chars[x]) for x in (i, j, k))
            out[code] = out.get(code, 0) + op.DECAY ** (k - i + 1)
    return out


def norm(word):
    """Root of the summed squares of the weights of all occurrences, as if no two were alike."""
    n = len(word) + 2
    return max(1e-12, sum(op.DECAY ** (2 * (k - i + 1)) for i, j, k in itertools.combinations(range(n), 3) if k - i < op.SPAN)) ** 0.5


def kernel(a, b):
    x, y = features(a), features(b)
    return sum(w * y.get(c, 0) for c, w in x.items()) / (norm(a) * norm(b))


WORDS = ["a", "ab", "idiot", "i.d.i.o.t", "idiiot", "idoit", "été", "漢字かな", "x" * 20, "aabbaabb", "grobnik", "gro-bnik"]


def test_kernel_against_landmarks():
    marks = op.Landmarks(["idiot", "grobnik", "table", "aabb"])
    want = [[kernel(w, m) for m in marks.words] for w in WORDS]
    assert np.allclose(marks.kernel(WORDS), want, atol=1e-12)
    assert np.allclose(marks.kernel(WORDS, step=3), want, atol=1e-12)


def test_inserted_characters_cost_weight_not_the_match():
    same, apart = kernel("idiot", "idiot"), kernel("table", "idiot")
    for other in ("i.diot", "idi-ot", "idiiot", "i.d.i.o.t"):
        assert 4 * apart < kernel(other, "idiot") and kernel(other, "idiot") > 0.2 * same


def test_collapsed_table_equals_the_landmark_sum():
    rng = np.random.default_rng(1)
    marks = op.Landmarks(["idiot", "grobnik", "table", "aabb", "xyz"])
    alpha, bias = rng.normal(size=5), 0.3
    model = op.Model(marks.codes, marks.table @ alpha, bias)
    want = [sum(a * kernel(w, m) for a, m in zip(alpha, marks.words)) + bias for w in WORDS]
    assert np.allclose(model.values(WORDS), want, atol=1e-12)


def test_sample_holds_what_the_texts_hold():
    """Numbers in place of words: sentences, their words and counts are those of the texts."""
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(40)] + ["a", "é", "b a d", "x.y"]
    texts = [" ".join(rng.choice(vocab) + rng.choice(["", "", ".", "!\n"]) for _ in range(rng.randrange(0, 40))) for _ in range(80)] + [None, "", texts_dup()]
    sample = op.Sample((i % 2, *op.Bag.of(t).packed()) for i, t in enumerate(texts))
    for i, t in enumerate(texts):
        assert sorted(sample.words[w] for w in sample.seen[i]) == sorted(set(op.words_of(t)))
        want = {frozenset(w for w in op.words_of(p) if len(w) > 2) for p in op.SENTENCE.split(t or "")} - {frozenset()}
        assert {frozenset(sample.words[w] for w in sample.words_in(np.array([s]))) for s in sample.held[i]} == want
        assert len(sample.held[i]) == len(want)
    assert sample.words == sorted(sample.words) and sample.labels.tolist() == [i % 2 for i in range(len(texts))]
    everyone = np.arange(len(texts))
    assert sample.texts_with(everyone).sum() == sum(len(h) for h in sample.held)


def texts_dup():
    return "one two three. one two three! three two one\none two"
