"""WARC: bounded archives, records read from their offsets, external merge; URL rules in several files."""

import gzip
import hashlib
import io
import random

import numpy as np
import pytest
from pyarrow import fs

from devicelens.llm import url_filter, warc

ENV = ["ARCHIVE_BYTES", "RUN_ROWS", "RUN_BATCH", "MAX_WAY"]


def pages(n=300, seed=1):
    rng = random.Random(seed)
    return [(i, f"http://{rng.choice('abc')}.org/{rng.randrange(20)}", rng.choice(["é" * 900, "x" * rng.randrange(3000), f"page {i} " * rng.randrange(200), None]))
            for i in range(n)]


def test_archives_are_bounded_and_seekable(spark, tmp_path, monkeypatch):
    rows = pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    path = warc.write_warc(df, f"file:{tmp_path}/w")
    listed = spark.read.parquet(f"{path}/{warc.MANIFEST}").collect()
    assert sum(r.n_records for r in listed) == len(rows)
    seen = 0
    for r in listed:
        data = open(f"{tmp_path}/w/{r.archive}", "rb").read()
        assert len(data) == r.n_bytes
        for at, fields, block in warc.parse_archive(io.BytesIO(data)):
            # a record stands alone at its offset
            again = next(warc.parse_archive(io.BytesIO(data[at:])))
            assert again[1:] == (fields, block)
            seen += 1
    assert seen == len(rows)
    # what a lost task has left is not read
    open(f"{tmp_path}/w/pages-lost.warc.gz", "wb").write(gzip.compress(b"WARC/1.0\r\n"))
    assert warc.read_warc(spark, path).count() == len(rows)


def test_archives_of_others(spark, tmp_path):
    """Whole-file gzip, several members, no compression: read alike."""
    rows = pages(60)
    path = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file:{tmp_path}/w")
    name = spark.read.parquet(f"{path}/{warc.MANIFEST}").first().archive
    plain = gzip.decompress(open(f"{tmp_path}/w/{name}", "rb").read())
    want = sorted(tuple(r)[:7] for r in warc.read_warc(spark, path).collect())
    for kind, data in (("gz", gzip.compress(plain)), ("plain", plain)):
        (tmp_path / kind).mkdir()
        (tmp_path / kind / f"a.warc{'.gz' if kind == 'gz' else ''}").write_bytes(data)
        assert sorted(tuple(r)[:7] for r in warc.read_warc(spark, f"file:{tmp_path}/{kind}").collect()) == want
    with pytest.raises(ValueError):
        list(warc.parse_archive(io.BytesIO(gzip.compress(plain)[:-20])))


@pytest.mark.parametrize("way", [2, 3, 256])
def test_runs_merge_in_bounded_passes(tmp_path, monkeypatch, way):
    monkeypatch.setattr(warc, "RUN_BATCH", 7)
    monkeypatch.setattr(warc, "MAX_WAY", way)
    rng, store, base = random.Random(way), fs.LocalFileSystem(), str(tmp_path)
    rows = [(f"k{rng.randrange(30)}", "2024", rng.choice([None, rng.randrange(99)]), 1, "d", "response", None, f"a{rng.randrange(9)}", i) for i in range(900)]
    runs = [sorted(rows[k::11], key=warc.run_order) for k in range(11)]
    index = [x for r in runs for x in warc.write_run(store, base, r)]
    assert all(x["batch"] < 12 for x in index) and len(index) == sum(-(-len(r) // 7) for r in runs)
    keys = sorted(warc.run_order(r) for r in rows)
    bounds = [keys[200], keys[201], keys[650]]
    batches = list(warc._ranges(bounds)([warc._index_batch(index)]))
    entries = sorted(zip(*(batches[0][c].to_pylist() for c in ("range", "run", "batch"))))
    import pyarrow as pa

    dealt = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*entries)], ["range", "run", "batch"])
    got = [r for b in warc._merged(base, bounds)([dealt]) for r in zip(*(b[c].to_pylist() for c in warc.RUN_COLUMNS))]
    assert [warc.run_order(r) for r in got] == keys
    # a range reads of each run only the batches that reach into it
    assert len([e for e in entries if e[0] == 1]) <= 2 * len(runs)


def test_global_order_over_many_runs(spark, tmp_path):
    rows = pages(500, 3) + [(1000 + i, "http://hot.org/", f"{i}") for i in range(400)]
    out = warc.warc_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)).collect()
    keys = [(r.urlkey, r.warc_date, r.page_id) for r in out]
    assert keys == sorted(keys) and len(out) == len(rows)
    digest = {i: hashlib.sha1((t or "").encode()).hexdigest() for i, _, t in rows}
    assert all(r.payload_digest == digest[r.page_id] for r in out)


def test_url_rules_in_several_files(spark, monkeypatch):
    rng = random.Random(5)
    hosts = ["org", "a.org", "b.a.org", "com", "x.com"]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), "/" + "".join(rng.choices("ab/", k=rng.randrange(4)))) for _ in range(60)]
    urls = [f"http://{rng.choice(['', 'w.'])}{rng.choice(hosts)}/{''.join(rng.choices('ab/', k=6))}" for _ in range(300)] + [None, "x"]
    one = url_filter.RuleIndex(np.frombuffer(url_filter.build_index(rules), np.uint8))
    parts = [url_filter.RuleIndex(np.frombuffer(url_filter.build_index(rules[k:k + 7]), np.uint8)) for k in range(0, 60, 7)]
    split = [(u.split("/")[2], "/" + u.split("/", 3)[3]) for u in urls if u and "://" in u]
    assert url_filter.judge_all(parts, *zip(*split)) == tuple(map(list, one.judge(*zip(*split))))
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    whole = sorted(map(tuple, url_filter.filter_urls(df, rules).collect()))
    monkeypatch.setattr(url_filter, "RULES_PER_FILE", 9)
    assert sorted(map(tuple, url_filter.filter_urls(df, iter(rules)).collect())) == whole
    assert url_filter.filter_urls(df, []).where("rule is null").count() == len(urls)
