"""The registered queries on the smallest table: oracles, and the pipeline end to end."""

import duckdb
import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
import __spark_entry__ as entry  # noqa: E402
from devicelens.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in names if q.startswith("op")}
    assert "pipeline" in names and set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = duck.sql(queries.ORACLE[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    assert got == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).collect()
    ids = [r.doc_id for r in out]
    assert 0 < len(ids) == len(set(ids)) <= docs.count()
    assert all(len(r.ids) == 4 * r.n_tokens for r in out)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]


def test_pipeline_rows_match_a_brute_force_chain(spark, tmp_path):
    """All rows of run(): toxicity by the stage's own decisions, lines and shingles by all
    pairs, windows by search, ids by the tokenizers library."""
    import hashlib
    import random
    import re

    from tokenizers import Tokenizer

    from devicelens.llm import toxicity
    from test_llm_operators import LOWER, components, line_reference, near, sentence

    rng = random.Random(12)
    long = [sentence(80) for _ in range(6)]
    item = " ".join(f"item{i}" for i in range(30))
    texts = [t for x in long for t in (x, near(x, 1), near(x, 30))]
    wrapped = lambda t, n: "\n".join(" ".join(t.split()[k:k + n]) for k in range(0, len(t.split()), n))
    # near copies by shingles, of which no line is like another
    texts += [wrapped(t, n) for t in (sentence(80) for _ in range(6)) for n in (10, 7)]
    texts += [f"{sentence(12)}\nshared line that all of them have\n{sentence(12)}" for _ in range(12)]
    texts += ["shared line that all of them have", None, "", " \n ", item, f"{item} {sentence(40)}", f"{sentence(400)} item1 item2"]
    texts += [f"{sentence(20)} {item}\n{sentence(700)}", f"{sentence(30)} {rng.choice(['été', 'The'])}!"]
    toxic = [f"{sentence(15)} grobnik. {sentence(5)}" for _ in range(60)]
    clean = [f"{sentence(15)}. {sentence(5)}" for _ in range(120)]
    docs = list(enumerate([*texts, *toxic, *clean], 1))
    first = len(texts) + 1
    labels = [(i, int(i < first + 60)) for i, _ in docs if i >= first]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids").collect())

    read = lambda t: spark.read.parquet(f"{tmp_path}/{t}.parquet")
    bad = {r.doc_id for r in toxicity.toxicity(read("documents"), read("labels")).where("predicted = 1").collect()}
    left = [d for d in docs if d[0] not in bad]
    sizes = [len(docs), len(left)]
    lines = []
    for (i, t), gone in zip(left, line_reference(left)):
        kept = t if not gone else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
        if not gone or re.search(r"[^\x20\x09-\x0D]", kept):
            lines.append((i, kept))
    left, sizes = lines, [*sizes, len(lines)]
    left = [d for d, c in zip(left, components(left, 5, 80)[1]) if d[0] == c]
    sizes.append(len(left))

    def contaminated(t):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        windows = {tuple(item.split()[k:k + 13]) for k in range(18)}
        hit = {p for k in range(len(words) - 12) if tuple(words[k:k + 13]) in windows for p in range(k, k + 13)}
        return len(hit) > 0 and 20 * len(hit) >= len(words)

    left = [d for d in left if not contaminated(d[1])]
    sizes.append(len(left))
    assert all(a > b for a, b in zip(sizes, sizes[1:])), sizes  # every stage has something to take out
    whole, want = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json")), []
    for i, t in left:
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids, "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), ids.tobytes()))
    assert [(*g[:4], bytes(g[4])) for g in got] == sorted(want)
