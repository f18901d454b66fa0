"""Every operator and stage on awkward tables, against brute force.

The table has NULLs in all columns, empty, blank and very long texts, rows that repeat
an id or a whole row, near and exact copies, and columns with names that the operators
use themselves."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from devicelens.llm import bpe, decontaminate, exact_dedup, hyperminhash, line_dedup, pii, token_store, toxicity, url_filter, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, row string, kept boolean, body long, "
          "`size` int, `doc` long, score double, line int, gone int, `left` string, contaminated boolean")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RNG = random.Random(20)
VOCAB = ["w%d" % i for i in range(300)] + ["The", "of", "été", "a"]


def sentence(n):
    return " ".join(RNG.choices(VOCAB, k=n))


BASE = sentence(120)
LONG = "\n".join(sentence(40) for _ in range(150))
ITEM = " ".join("item%d" % i for i in range(30))


def near(text, changes):
    words = text.split()
    for i in RNG.sample(range(len(words)), changes):
        words[i] = "changed%d" % RNG.randrange(10 ** 6)
    return " ".join(words)


def documents():
    texts = [(1, BASE), (2, BASE.upper()), (3, near(BASE, 2)), (4, near(BASE, 20)), (5, BASE.replace(" ", "  ")), (6, None), (7, ""),
             (8, " \t\n "), (9, "two words"), (10, "TWO words"), (11, "one"), (12, LONG), (13, LONG + "\nmore " + sentence(5)),
             (14, sentence(9)), (15, ITEM + " " + sentence(30)), (16, "item0 " + sentence(300) + " " + ITEM), (17, near(BASE, 3)),
             (17, sentence(20)), (17, sentence(20)), (18, "same row"), (18, "same row"), (None, BASE), (None, None), (None, "no id here"),
             (19, "first line of words\nshared line that all of them have\n\n  \nlast"),
             (20, "Shared line that all of them have\nother line"), (21, "shared line that all of them have"),
             (22, "mail a.b@c.de and +1 (555) 123-4567 and 10.0.0.255\nfor 4111 1111 1111 1111."), (23, "x" * 5000),
             (24, "the shared line that all of them have here now")]
    texts += [(100 + i, near(BASE, RNG.choice([0, 1, 5, 9]))) for i in range(40)]
    return [(i, t, None if i == 9 else "en", None, len(t) if t else None, 1, "r", None, 5, 6, 7, 0.5, 8, 9, "l", None) for i, t in texts]


ROWS = documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_dedup(docs, none):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    got = exact_dedup.exact_dedup(docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    groups = {}
    for r in ROWS:
        groups.setdefault(norm(r[1]), []).append(r[0])
    want, kept = [], 0
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
        kept += 1
    out = got.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=repr) == sorted(want, key=repr)
    assert sum(r.kept for r in out) == kept and all(r.doc_id == r.keep_id for r in out if r.kept)
    assert exact_dedup.exact_dedup(none).count() == 0


def components(texts, words, percent):
    """Least id by brute force over all pairs."""
    def shingles(t):
        w = [x.translate(LOWER) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])
    sets = [shingles(t) for _, t in texts]
    label = [i for i, _ in texts]
    changed = True
    while changed:
        changed = False
        for a, x in enumerate(sets):
            for b, y in enumerate(sets[:a]):
                if x and y and None not in (label[a], label[b]) and label[a] != label[b] and 100 * len(x & y) >= percent * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return sets, label


def test_near_duplicates(docs, none):
    got = hyperminhash.near_duplicates(docs, words=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")
    texts = [(r[0], r[1]) for r in ROWS]
    sets, label = components(texts, 4, 80)
    # texts under one id are nodes of one name: the unrelated rows of 17 go with the near copy of 1
    want = [(i, len(s), x if i != 17 else 1, i == x and i != 17) for (i, _), s, x in zip(texts, sets, label)]
    assert {x for i, x in zip([i for i, _ in texts], label) if i == 17} == {1, 17}
    assert rows(got) == sorted(want, key=repr)
    assert hyperminhash.near_duplicates(none).count() == 0


def test_near_duplicate_stage_keeps_columns(docs):
    out = hyperminhash.drop_near_duplicates(docs)
    assert out.schema == docs.schema
    _, label = components([(r[0], r[1]) for r in ROWS], 5, 80)
    linked = {i for i, x in zip([r[0] for r in ROWS], label) if i != x}  # ids of which some text has a lesser one
    want = [r for r in ROWS if r[0] not in linked]
    assert rows(out) == sorted(want, key=repr)


def line_reference(texts, percent=80):
    """(removed line numbers) of every row, by brute force."""
    lines = []
    for k, (i, t) in enumerate(texts):
        for n, line in enumerate((t or "").split("\n")):
            lines.append(((i is None, i or 0), k, n, frozenset(re.split(r"[\x20\x09-\x0D]+", line.lower())) - {""}))
    gone = [set() for _ in texts]
    for at, k, n, s in lines:
        for at2, k2, n2, s2 in lines:
            same_text = at == at2 and texts[k][1] == texts[k2][1]
            if at == at2 and not same_text:
                continue  # rows that repeat an id are ordered by a hash: see below
            earlier = (at2, n2) < (at, n)
            if s and s2 and earlier and 100 * len(s & s2) >= percent * len(s | s2):
                gone[k].add(n)
    return gone


def test_line_dedup(docs, none):
    once = docs.where("doc_id is not null and doc_id != 17")
    texts = [(r[0], r[1]) for r in ROWS if r[0] not in (None, 17)]
    out = line_dedup.dedup_lines(once)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    want = []
    for (i, t), gone in zip(texts, line_reference(texts)):
        lines = (t or "").split("\n")
        want.append((i, t if not gone else "\n".join(x for n, x in enumerate(lines) if n not in gone), len(lines), len(gone)))
    assert rows(out.select("doc_id", "text", "n_lines", "n_removed")) == sorted(want, key=repr)
    stage = line_dedup.drop_repeated_lines(docs)
    assert stage.schema.fieldNames() == docs.columns
    kept = {r.doc_id: r for r in stage.collect()}
    assert 21 not in kept and 2 not in kept  # nothing is left of them
    assert {1, 6, 7, 8, 9, 12, 19} <= set(kept) and kept[19].text == ROWS[24][1]
    assert kept[20].text == "other line" and kept[20].n_chars == 10
    assert line_dedup.dedup_lines(none).count() == 0


def test_tokens_round_trip(docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    got = token_store.token_round_trip(docs, path, end_id=2).collect()
    texts = sorted(((r[0] is not None, r[0] or 0, r[0], r[1]) for r in ROWS), key=lambda x: x[:2])
    parts = {}
    for _, _, i, t in texts:
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        parts.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    mine = {}
    for r in got:
        mine.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in mine.items()} == {k: sorted(v) for k, v in parts.items()}
    order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in order] == np.concatenate([[0], np.cumsum([r.n_tokens for r in order])[:-1]]).tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in order]
    assert ids == sorted(ids)
    assert token_store.token_round_trip(none, path).count() == 0


def test_byte_pairs(docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    got = bpe.bpe_digests(docs, path, with_ids=True)
    want = []
    for r in ROWS:
        ids = np.array(whole.encode(r[1] or "", add_special_tokens=False).ids, "<u4")
        want.append((r[0], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert rows(got.drop("ids")) == sorted(want, key=repr)
    text = bpe.bpe_decode(bpe.bpe_encode(docs, path), path)
    assert rows(text) == sorted([(r[0], r[1] or "") for r in ROWS], key=repr)
    assert bpe.bpe_digests(none, path).count() == 0


def test_contamination_stage(spark, docs, none):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "shared line that"), (None, "two words"), (1, ITEM)], "item_id long, text string")
    got = {(r.doc_id, r.n_words): r for r in decontaminate.contamination(docs, bench).collect()}
    by_id = {k[0]: r for k, r in got.items()}
    assert by_id[15].n_hit == 30 and by_id[15]["items"] == ["1"] and by_id[15].contaminated
    assert [tuple(s) for s in by_id[16].spans] == [(301, 331)] and by_id[16].contaminated
    assert by_id[9]["items"] == [""] and by_id[10].n_hit == 2 and by_id[19]["items"] == ["4"]
    assert by_id[6].n_words == 0 and not by_id[6].contaminated and by_id[1].n_hit == 0
    out = decontaminate.drop_contaminated(docs, bench)
    bad = {i for i, r in by_id.items() if r.contaminated}
    assert out.schema == docs.schema and rows(out) == sorted([r for r in ROWS if r[0] not in bad], key=repr)
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]"]


def base_spans(text):
    def luhn(d):
        total = sum(x - 9 if (x := int(c) * (1 + i % 2)) > 9 else x for i, c in enumerate(reversed(d)))
        return total % 10 == 0

    def good(k, m):
        d = re.sub("[^0-9]", "", m)
        return [True, k == 1 and all(int(x) <= 255 for x in m.split(".")), 16 <= len(d) <= 19 and luhn(d), 8 <= len(d) <= 15][k]

    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if good(k, m[0])]


def test_personal_data(spark, docs, none):
    rng = random.Random(2)
    chars = list("0123456789") * 2 + list("@..++--  ()aZ_%é\n\U0001f600") + ["4111111111111111", "255", "a@b.co", "+1 555 123 4567"]
    odd = [(1000 + i, "".join(rng.choice(chars) for _ in range(rng.randint(0, 40)))) for i in range(1500)]
    odd += [(9000, "1" * 20000 + "@" + "a." * 20000 + "b"), (9001, "+" + "1(" * 20000 + "x"), (9002, "5 " * 20000)]
    some = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    all_texts = [(r[0], r[1]) for r in ROWS] + odd
    got = pii.pii_digests(some).collect()
    want = []
    for i, t in all_texts:
        b = base_spans(t or "")
        text = ",".join(f"{pii.KINDS[k]}:{x}:{y}" for k, x, y in b)
        want.append((i, *[sum(s[0] == k for s in b) for k in range(4)], hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
    spans = {r.doc_id: r.spans for r in got}
    for i, t in all_texts:
        if i and i >= 1000:
            assert {f"{pii.KINDS[k]}:{x}:{y}" for k, x, y in base_spans(t)} <= set(spans[i].split(","))
    assert pii.pii_digests(none.select("doc_id", "text")).count() == 0
    found = pii.find_pii(docs.where("doc_id = 22")).select("doc_id", "base")
    clean = docs.where("doc_id = 22").join(found, "doc_id").select(pii.redact(F.col("text"), F.col("base"))).first()[0]
    assert clean == "mail [email] and [phone] and [ip]\nfor [card]."


def test_url_filter(spark):
    pages = spark.createDataFrame([(1, "http://A.Example.org/es/x?q#f", 1), (2, "https://x.com", 1), (2, "https://x.com/de/", 2), (3, None, 1),
                                   (4, "", 1), (None, "no scheme", 1), (5, "ftp://h:8/p#a?b", 1), (6, "http://y.com?/de/", 1),
                                   (7, "http://badexample.org/es/" + "z" * 5000, 1)], "page_id long, url string, rule int")
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "com", "/de/")]
    got = {(r.page_id, r.path): (r.host, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules, default="block").collect()}
    assert got == {(1, "/es/x"): ("a.example.org", "example.org/es/", "block"), (2, ""): ("x.com", None, "block"),
                   (2, "/de/"): ("x.com", "com/de/", "block"), (3, ""): ("", None, "block"), (4, ""): ("", None, "block"),
                   (None, ""): ("", None, "block"), (5, "/p"): ("h:8", None, "block"), (6, ""): ("y.com", None, "block"),
                   (7, "/es/" + "z" * 5000): ("badexample.org", "org/", "allow")}
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    assert url_filter.filter_urls(pages, []).where("verdict = 'allow' and rule is null").count() == 9


def test_warc_round_trip(spark):
    big, other = "é" * 700 + "WARC/1.0\r\n\r\n", "x" * 1000
    pages = spark.createDataFrame([(1, "http://b.a/x", big), (2, "http://b.a/x", big), (3, None, big), (4, "http://a\r\nb/", "short"),
                                   (5, "", "short"), (6, "u", None), (7, "http://c.a/", other), (7, "http://c.a/", other), (8, "h", ""),
                                   (None, "n", big), (None, "n", None)], "page_id long, url string, html string")
    out = warc.warc_round_trip(pages).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=repr)
    def one(i, t, kind="response", to=None):
        return (i, len(t.encode()), hashlib.sha1(t.encode()).hexdigest(), kind, to)
    want = [one(1, big, "revisit", 3), one(2, big, "revisit", 3), one(3, big), one(4, "short"), one(5, "short"), one(6, ""), one(7, other),
            one(7, other), one(8, ""), one(None, big, "revisit", 3), one(None, "")]
    assert got == sorted(want, key=repr)
    keys = [(r.urlkey, r.warc_date) for r in out]
    assert keys == sorted(keys)  # globally ordered capture histories
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_toxicity_stage(spark, docs, none):
    rng = random.Random(4)
    extra = [(2000 + i, " ".join(rng.choices(VOCAB, k=20)) + (" grobnik." if i % 3 == 0 else "."), i % 3 == 0) for i in range(300)]
    rest = ROWS[0][2:]
    more = spark.createDataFrame([(i, t, *rest) for i, t, _ in extra], SCHEMA)
    labels = spark.createDataFrame([(i, int(x)) for i, _, x in extra] + [(2000, 1), (2000, None), (None, 1), (99999, 0)], "doc_id long, toxic int")
    everything = docs.unionByName(more)
    got = {r.doc_id: r for r in toxicity.toxicity(everything, labels).collect() if r.doc_id and r.doc_id >= 2000}
    held = [(i, x) for i, _, x in extra if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r.held_out} == {i for i, _ in held}
    assert sum(got[i].predicted == x for i, x in held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in got.values())
    stage = toxicity.drop_toxic(everything, labels)
    assert stage.schema == docs.schema
    left = {r.doc_id for r in stage.select("doc_id").collect()}
    assert {r[0] for r in ROWS} <= left  # clean documents, and those without words or ids, stay
    assert len([i for i, _, x in extra if x and i in left]) <= 5
    assert toxicity.toxicity(none, labels).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).where("predicted = 0").count() == len(ROWS)


def test_personal_data_adds_loose_spans(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    mail = lambda at, dot: f"{word()}.{word()}{at}{word()}{dot}{rng.choice(['com', 'org', 'de'])}"
    digits = lambda n: str(rng.randint(10 ** (n - 1), 10 ** n - 1))
    loose = {"email": [lambda: mail(" (at) ", " (dot) "), lambda: mail(" at ", " dot "), lambda: mail("[AT]", "."), lambda: mail(" AT ", " DOT ").upper()],
             "phone": [lambda: f"({digits(3)}) 555-{digits(4)}", lambda: f"1 ({digits(3)}) 555-{digits(4)}", lambda: f"{digits(3)}.555.{digits(4)}"]}
    none = [lambda: f"{rng.randint(1950, 2029)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", lambda: f"{rng.randint(10, 28)}/10/{rng.randint(1950, 2029)}",
            lambda: "4111 1111 1111 1112", lambda: f"1.{digits(2)}.3.{digits(2)}.5", lambda: f"look at {word()} dot matrix"]
    texts, want = [], {}
    for i in range(400):
        kind = rng.choice([*loose, "base", "none"])
        found = rng.choice(loose[kind])() if kind in loose else rng.choice(none)() if kind == "none" else f"{mail('@', '.')} +1 ({digits(3)}) 555-{digits(4)}"
        texts.append((i, f"{sentence(3)}, {found}, {sentence(3)}"))
        want[i] = {(pii.KINDS.index(kind), len(texts[-1][1].split(", ")[0]) + 2, len(texts[-1][1].split(", ")[0]) + 2 + len(found))} if kind in loose else set()
    # more loose spans than base ones, so that they cannot win by being rare
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: {tuple(s) for s in r.added} for r in pii.find_pii(docs).collect()}
    real = [i for i in want if want[i]]
    missed, wrong = [texts[i] for i in real if got[i] != want[i]], [(texts[i], got[i]) for i in want if not want[i] and got[i]]
    assert len(missed) <= 0.05 * len(real), missed
    assert len(wrong) <= 0.02 * len(want), wrong


@pytest.mark.parametrize("block", [1, 7])
def test_contamination_in_blocks_of_windows(spark, docs, monkeypatch, block):
    items = [(1, ITEM), (2, None), (3, ""), (4, "shared line that"), (None, "two words"), (5, BASE), (6, ITEM + " " + BASE)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = rows(decontaminate.contamination(docs, bench))
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    used = decontaminate.shared_benchmark(spark, [(str(i), (t or "").encode()) for i, t in items], 13)
    assert len(used.paths) > 10 and all(len(b.owners) <= block for b in used.blocks())
    assert rows(decontaminate.contamination(docs, bench)) == whole
    assert any(len(r[4]) >= 2 for r in whole) and not hasattr(decontaminate, "MAX_BENCHMARK_BYTES")


def test_stages_with_dotted_and_clashing_names(spark, docs):
    """Columns may have dots in their names; names that an operator adds are refused."""
    odd = docs.withColumnRenamed("source", "meta.url").withColumn("a.b.c", F.lit(1))
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (5, 1)], "doc_id long, toxic int")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    for out in (toxicity.drop_toxic(odd, labels), hyperminhash.drop_near_duplicates(odd), decontaminate.drop_contaminated(odd, bench),
                line_dedup.drop_repeated_lines(odd)):
        assert out.columns == odd.columns and 0 < out.count() <= len(ROWS)
    with pytest.raises(ValueError, match="n_removed"):
        line_dedup.dedup_lines(odd.withColumn("n_removed", F.lit(1)))
