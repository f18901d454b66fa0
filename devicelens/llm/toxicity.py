"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks (operator 8).

Kernel: two words are alike as far as they share subsequences of three characters,
each weighted by DECAY to the power of the span it takes (gaps and inserted
characters cost weight, not the match), divided by a norm of the word's length. A
sentence's value is that of its most toxic word, a text's that of its most toxic
sentence, learned as a multiple-instance SVM: sentences inherit the label of their
text, the witness word of each toxic text is chosen again after every fit, and the
worst false alarms join the negatives.

The SVM works on Nystroem features of a few landmark words. Its decision is linear
in the kernel values against them, so after training they collapse into one table of
weights by subsequence, with which the workers score words (each once).
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

DECAY = 0.75
SPAN = 7                      # longest stretch of a subsequence of three characters
SYMBOLS = 64
LANDMARKS = 192
#: Bounds of the training sample: texts of each label, and the longest text taken.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_BYTES = 3000, 5000, 1 << 16
FETCHES = 16                  # tasks that make the sample's bags
BATCH_ROWS = 512
MAX_BROADCAST_KEYS = 1_000_000  # rejected rows (16 bytes each) that are taken out by a broadcast
ROUNDS = 4
CACHE = 1_000_000             # remembered words per worker
THRESHOLD = 0.3
LOW = -3.0                    # value of a text without words
HELD_OUT = 2
SPLIT_MARK = "\x1f"           # white space to str.split(): in no word
SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)")
OFFSETS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]


def words_of(text: str | None) -> list[str]:
    """Lower-cased words; a word spelt out with spaces (``b a d``) also counts as one."""
    if not text:
        return []
    low = text.lower()
    words = low.split()
    if spaced := SPACED.findall(low):
        words += [s.replace(" ", "").replace("\t", "") for s in spaced]
    return words


def _occurrences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word number, subsequence code, weight) of all occurrences, by offsets. The start and
    the end of a word are characters too."""
    joined = "".join(f"\0{w}\1" for w in words)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = (points >= 97) & (points <= 122)
    c = np.where(letter, points - 96, np.where(points == 0, 0, 27 + points % (SYMBOLS - 27)))
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    for i, j in OFFSETS:
        if len(c) <= j:
            continue
        at = np.flatnonzero(owner[:-j] == owner[j:])
        yield owner[at], (c[at] * SYMBOLS + c[at + i]) * SYMBOLS + c[at + j], DECAY ** (j + 1)


def norms(words: list[str]) -> np.ndarray:
    """Root of the summed squared weights of a word of that length."""
    n = np.array([len(w) + 2 for w in words], float)
    square = sum((DECAY ** (2 * (j + 1))) * np.maximum(n - j, 0) for _, j in OFFSETS)
    return np.sqrt(np.maximum(square, 1e-12)) if len(words) else n


class Landmarks:
    """Kernel values of words against the landmark words."""

    def __init__(self, words: list[str]):
        self.words = words
        parts = list(_occurrences(words))
        self.codes = np.unique(np.concatenate([c for _, c, _ in parts]))
        self.table = np.zeros((len(self.codes), len(words)))
        for owner, code, weight in parts:
            np.add.at(self.table, (np.searchsorted(self.codes, code), owner), weight)
        self.table /= norms(words)

    def kernel(self, words: list[str], step: int = 256) -> np.ndarray:
        out = np.zeros((len(words), len(self.words)))
        for k in range(0, len(words), step):
            part = words[k:k + step]
            cells, weights = [], []
            for owner, code, weight in _occurrences(part):
                at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                hit = self.codes[at] == code
                cells.append(owner[hit] * len(self.codes) + at[hit])
                weights.append(np.full(len(cells[-1]), weight))
            if cells:
                counts = np.bincount(np.concatenate(cells), np.concatenate(weights), len(part) * len(self.codes))
                out[k:k + step] = counts.reshape(len(part), -1) @ self.table / norms(part)[:, None]
        return out


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Linear SVM with squared hinge loss by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(30):
        margin = 1 - y * (x @ w)
        on = margin > 0
        a = x[on] * weight[on, None]
        step = np.linalg.solve(a.T @ x[on] + np.diag(penalty), a.T @ (y[on] * margin[on]) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """Weights by subsequence, bias, and the calibration of a text's value."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray, bias: float, slope: float = 1.0, offset: float = 0.0):
        self.codes, self.weights, self.bias, self.slope, self.offset = codes, weights, bias, slope, offset

    @functools.cached_property
    def dense(self) -> np.ndarray:
        out = np.zeros(SYMBOLS ** 3)
        out[self.codes] = self.weights
        return out

    def __getstate__(self):
        return (self.codes, self.weights, self.bias, self.slope, self.offset)

    def __setstate__(self, state):
        self.__init__(*state)

    def values(self, words: list[str], step: int = 20_000) -> np.ndarray:
        """SVM decision of every word."""
        parts = [np.zeros(0)]
        for k in range(0, len(words), step):
            part = words[k:k + step]
            out = np.zeros(len(part))
            for owner, code, weight in _occurrences(part):
                out += weight * np.bincount(owner, self.dense[code], minlength=len(part))
            parts.append(out / norms(part) + self.bias)
        return np.concatenate(parts)

    def score(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.maximum(value, LOW) + self.offset, -30, 30)))


def calibrate(value: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve (Newton, lightly ridged)."""
    x = np.stack([value, np.ones(len(value))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, (x * (weight * (y - p))[:, None]).sum(0) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def disguised(word: str, rng) -> str:
    """The word with inserted characters: one, or one between all letters, or a letter doubled."""
    mark, kind, at = rng.choice(list("-.*_")), rng.integers(3), int(rng.integers(1, len(word)))
    if kind == 0:
        return word[:at] + mark + word[at:]
    return mark.join(word) if kind == 1 else word[:at] + word[at - 1] + word[at:]


class Bag:
    """A text as its distinct words and, by their numbers, the word sets of its sentences."""

    def __init__(self, words: list[str], split: list[str], sentences: list[list[int]]):
        self.words, self.split, self.sentences = words, split, sentences

    @classmethod
    def of(cls, text: str | None) -> "Bag":
        """Words of one or two characters are in no sentence; ``split`` are words that only
        the end of a sentence makes (in words spelt out with spaces)."""
        parts = list(dict.fromkeys(frozenset(w for w in words_of(p) if len(w) > 2) for p in SENTENCE.split(text or "")))
        words = sorted(set(words_of(text)))
        split = sorted({w for p in parts for w in p} - set(words))
        place = {w: i for i, w in enumerate([*words, *split])}
        return cls(words, split, [sorted(place[w] for w in p) for p in parts if p])

    def packed(self) -> tuple[str, bytes]:
        """Words by lines (no word has white space), and the sentences' numbers, each closed by -1."""
        return ("\n".join(self.words) + SPLIT_MARK + "\n".join(self.split),
                np.array([i for s in self.sentences for i in (*s, -1)], np.int32).tobytes())


class Sample:
    """Labelled texts as arrays of numbers: of words (in their sorted order) and of distinct sentences."""

    def __init__(self, packed: Iterable[tuple[int, str, bytes]]):
        """``packed``: (label, words, sentences) of each text, read once and let go."""
        number: dict[str, int] = {}
        sentence: dict[bytes, int] = {}
        labels, seen, held, flat, sizes = [], [], [], array("i"), array("q")
        for label, words, coded in packed:
            whole, split = (x.split("\n") if x else [] for x in words.split(SPLIT_MARK))
            own = np.array([number.setdefault(w, len(number)) for w in (*whole, *split)], np.int32)
            codes, ids = np.frombuffer(coded, np.int32), []
            for part in np.split(codes, np.flatnonzero(codes < 0) + 1)[:-1]:
                part = np.sort(own[part[:-1]])
                key = hashlib.blake2b(part.tobytes(), digest_size=16).digest()
                if key not in sentence:
                    sentence[key] = len(sentence)
                    flat.frombytes(part.tobytes())
                    sizes.append(len(part))
                ids.append(sentence[key])
            labels.append(label)
            seen.append(own[:len(whole)])
            held.append(np.array(ids, np.int64))
        self.words = sorted(number)
        rank = np.empty(len(number), np.int32)
        rank[[number[w] for w in self.words]] = np.arange(len(number), dtype=np.int32)
        self.labels, self.seen, self.held = np.array(labels, int), [rank[x] for x in seen], held
        self.flat = rank[np.frombuffer(flat, np.int32)] if flat else rank[:0]
        self.starts = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64) if sizes else [])]).astype(np.int64)

    def words_in(self, sentences: np.ndarray) -> np.ndarray:
        """Words of some sentences, as often as they stand there."""
        return np.concatenate([self.flat[self.starts[s]:self.starts[s + 1]] for s in sentences]) if len(sentences) else self.flat[:0]

    def texts_with(self, rows: np.ndarray) -> np.ndarray:
        """Number of the texts ``rows`` that hold each sentence."""
        held = [self.held[r] for r in rows]
        return np.bincount(np.concatenate(held) if held else np.zeros(0, np.int64), minlength=len(self.starts) - 1)


def learn(sample: Sample, toxic: np.ndarray, clean: np.ndarray, seed: int) -> Model:
    """SVM of some of the sample's texts (by number); not yet calibrated.

    Clean texts weigh against a word, none forbids it: a toxic text's witness is one of
    its words that no clean sentence has or that toxic ones have more often beyond chance,
    or else its most associated word. A word counts as positive by its share of toxic
    against clean sentences, as negative by the rest. Sentences count once, however often
    copied; those as common in clean texts as in toxic ones are left out of toxic texts."""
    rng, names, n_words = np.random.default_rng(seed), sample.words, len(sample.words)
    in_clean, in_toxic = sample.texts_with(clean), sample.texts_with(toxic)
    own = (in_toxic > 0) & (in_toxic * len(clean) > in_clean * len(toxic))
    good = np.bincount(sample.words_in(np.flatnonzero(in_clean)), minlength=n_words)
    bad = np.bincount(sample.words_in(np.flatnonzero(own)), minlength=n_words)
    ratio = max(1, int((in_clean > 0).sum())) / max(1, int(own.sum()))
    share = np.where(bad > 0, bad * ratio / np.maximum(bad * ratio + good, 1e-300), 0.0)
    # association: log odds of toxic against clean sentences, less two standard errors
    tied = np.log((bad + 0.5) * ratio / (good + 0.5)) - 2 * np.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))

    def candidates(text: int) -> tuple:
        held = sample.held[text]
        words = np.unique(sample.words_in(held[own[held]]))
        some = words[(good[words] == 0) | (tied[words] > 0)]
        return tuple((some if len(some) else words[np.lexsort((words, -tied[words]))[:1]]).tolist())

    bags = [np.array(b) for b in dict.fromkeys(map(candidates, toxic)) if b]
    if not bags:
        return Model(np.zeros(0, np.int64), np.zeros(0), LOW)
    everyone = np.unique(np.concatenate(bags))
    marked = everyone[np.lexsort((everyone, -tied[everyone]))][:LANDMARKS // 2]
    pool = np.flatnonzero(good)
    common = pool[np.lexsort((pool, -good[pool]))][:LANDMARKS // 4]
    rest = np.setdiff1d(pool, common)
    drawn = rest[rng.choice(len(rest), min(len(rest), LANDMARKS // 4), replace=False)] if len(rest) else rest
    marks = Landmarks([names[w] for w in dict.fromkeys([*marked.tolist(), *common.tolist(), *drawn.tolist()])])
    values, vectors = np.linalg.eigh(marks.kernel(marks.words))
    keep = values > 1e-6 * values.max()
    project = vectors[:, keep] / np.sqrt(values[keep])

    pooled = [names[w] for w in pool]
    some = set(pool[rng.choice(len(pool), min(len(pool), 4000), replace=False)].tolist()) | set(common.tolist()) if len(pool) else set()

    def chosen(value: np.ndarray) -> Counter:
        """How many bags each word is the witness of: the one of the highest value, the last of equal ones."""
        return Counter(int(b[len(b) - 1 - np.argmax(value[b][::-1])]) for b in bags)

    witnesses = chosen(tied)
    for _ in range(ROUNDS):
        negatives, positives = sorted(some), sorted(witnesses)
        masked = [disguised(names[w], rng) for w in positives for _ in range(3)]
        plain = [disguised(names[w], rng) for w in negatives[::4]]
        x = marks.kernel([names[w] for w in positives] + masked + [names[w] for w in negatives] + plain) @ project
        label = np.repeat([1.0, -1.0], [len(positives) + len(masked), len(negatives) + len(plain)])
        counted = np.array([witnesses[w] * share[w] for w in positives])
        left = 1 - share[negatives] if negatives else np.zeros(0)
        weight = np.concatenate([counted, np.repeat(counted, 3) / 4, left * np.sqrt(1.0 + good[negatives]) if negatives else left, left[::4]])
        weight[label > 0] *= weight[label < 0].sum() / weight[label > 0].sum()
        w = fit_svm(x, label, weight)
        model = Model(marks.codes, marks.table @ (project @ w[:-1]), float(w[-1]))
        value = np.zeros(n_words)
        value[everyone] = model.values([names[w] for w in everyone])
        witnesses = chosen(value + share * np.log1p(bad))
        some |= set(pool[np.argsort(-model.values(pooled))[:1500]].tolist()) if pooled else set()
    return model


def train(texts: list[str], toxic: list[int], clean_weight: float = 1.0, seed: int = 7) -> Model:
    """Model of labelled texts, see :func:`fit_sample`."""
    return fit_sample(Sample((y, *Bag.of(t).packed()) for t, y in zip(texts, toxic)), clean_weight, seed)


def fit_sample(sample: Sample, clean_weight: float = 1.0, seed: int = 7) -> Model:
    """Model of a sample, calibrated on texts it was not fitted to.

    ``clean_weight``: how many clean texts of the corpus each one stands for, against
    toxic ones. Without both labels every score is the share of toxic ones. A small
    sample is fitted once more as a whole, keeping the calibration."""
    y = sample.labels
    usable = np.array([len(h) > 0 for h in sample.held], bool)
    if not (usable & (y == 1)).any() or not (y == 0).any():
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    fitting = np.random.default_rng(seed).random(len(y)) < 0.7
    if not (usable & fitting & (y == 1)).any() or len(set(y[~fitting])) < 2:
        fitting[:] = True
    holding = ~fitting if not fitting.all() else fitting

    def chosen(rows, label):
        return np.flatnonzero((y == label) & rows & usable)

    model = learn(sample, chosen(fitting, 1), chosen(fitting, 0), seed)
    top = np.array([model.values([sample.words[w] for w in sample.seen[t]]).max(initial=LOW) for t in np.flatnonzero(holding)])
    truth = y[holding]
    curve = calibrate(np.maximum(top, LOW), truth, np.where(truth == 1, 1.0, clean_weight))
    if (y == 1).sum() < 300 and not fitting.all():
        model = learn(sample, chosen(usable, 1), chosen(usable, 0), seed)
    model.slope, model.offset = curve
    return model


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == HELD_OUT, F.lit(False))


def _bags(batches: Iterable) -> Iterator:
    """Texts to packed bags, in the executors."""
    import pyarrow as pa

    for batch in batches:
        for k in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(k, BATCH_ROWS)
            words, sentences = zip(*(Bag.of(t).packed() for t in part["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["text_hash"], part["toxic"], pa.array(words, pa.string()), pa.array(sentences, pa.binary())],
                                             ["doc_id", "text_hash", "toxic", "words", "sentences"])


def _fitted(sizes: dict[int, int]):
    """The whole sample's bags to the model, as one row: a task for SAMPLE_TOXIC + SAMPLE_CLEAN texts."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        sample = Sample(x for b in batches for x in zip(b["toxic"].to_pylist(), b["words"].to_pylist(), b["sentences"].to_pylist()))
        n_toxic, n_clean = int((sample.labels == 1).sum()), int((sample.labels == 0).sum())
        clean_weight = (sizes.get(0, 0) / max(1, n_clean)) / max(1e-9, sizes.get(1, 0) / max(1, n_toxic)) if n_toxic else 1.0
        model = fit_sample(sample, clean_weight or 1.0)
        values = [model.codes.astype(np.int64).tobytes(), model.weights.astype(float).tobytes(), float(model.bias), float(model.slope), float(model.offset)]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["codes", "weights", "bias", "slope", "intercept"])
    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on a bounded sample of labelled texts outside the held-out quarter.

    The sample's ids are chosen by hash among all labels; its texts (of at most SAMPLE_BYTES
    each) become bags of words and sentences, and one task fits the model to them, so the
    driver gets the model alone. Label counts cover all labels."""
    rows = labels.where("toxic in (0, 1)").where(~held_out("doc_id")).select("doc_id", "toxic")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = dict(rows.groupBy("toxic").count().collect())
    order = F.xxhash64("doc_id")
    picked = (rows.where("toxic = 1").orderBy(order).limit(SAMPLE_TOXIC)
              .unionByName(rows.where("toxic = 0").orderBy(order).limit(SAMPLE_CLEAN)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    texts = texts.where(F.octet_length("text") <= SAMPLE_BYTES).join(F.broadcast(picked), "doc_id")
    texts = stored(texts, "toxicity-sample")
    bags = texts.repartition(FETCHES, F.xxhash64("doc_id", "text")).mapInArrow(_bags, "doc_id long, text_hash long, toxic int, words string, sentences binary")
    whole = stored(bags, "toxicity-bags").repartition(1).sortWithinPartitions("doc_id", "text_hash")
    row = whole.mapInArrow(_fitted(sizes), "codes binary, weights binary, bias double, slope double, intercept double").first()
    if row is None:  # no sample, and so no task
        return fit_sample(Sample([]))
    return Model(np.frombuffer(row.codes, np.int64), np.frombuffer(row.weights, np.float64), row.bias, row.slope, row.intercept)


def score_texts(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """id, ``score``, ``predicted`` of every row; NULL counts as an empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        model, known = shared.value, {}
        for batch in batches:
            best = []
            for k in range(0, batch.num_rows, 256):
                split = [words_of(t) for t in batch["text"].slice(k, 256).to_pylist()]
                new = list({w for words in split for w in words if w not in known})
                known.update(zip(new, model.values(new).tolist()))
                best += [max(map(known.__getitem__, words), default=LOW) for words in split]
                if len(known) > CACHE:
                    known = {}
            score = model.score(np.array(best, float))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             ["id", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL("score double, predicted int")])
    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows scored at ``threshold`` or more; all columns stay as they are.

    Only ids and texts are scored; rows go by id and text hash, so equal rows go together."""
    body = F.xxhash64("text")
    named = docs.select(F.struct("doc_id", body.alias("body")).alias("id"), "text")
    scored = score_texts(named, fit(docs, labels), threshold, id_col="id").where("predicted = 1")
    out = stored(scored.select(F.col("id.doc_id").alias("_id"), F.col("id.body").alias("_body")).distinct(), "toxicity-rejected")
    if out.count() <= MAX_BROADCAST_KEYS:
        out = F.broadcast(out)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", body.alias("body"))
    return rows.join(out, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body")), "left_anti").select("row.*")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``.

    Labels (``doc_id, toxic``) of the held-out quarter, NULL labels and NULL ids are
    not learned from; a text without words gets the score of the least toxic word
    there can be. Repeated rows are scored one by one; other columns are not read."""
    scored = score_texts(docs, fit(docs, labels), threshold)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
