"""Executor memory of operators 1 and 5: bytes that go to Python at once, and what a worker keeps."""

import pytest

from devicelens.llm import common, hyperminhash, line_dedup


def test_jobs_of_wide_rows_send_small_batches(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e\nf g"), (2, "a b c d e\nh"), (None, None)], "doc_id long, text string")
    before = spark.conf.get(common.ARROW_BYTES, None)
    seen = []

    def recording(stored):
        return lambda df, name: seen.append(int(spark.conf.get(common.ARROW_BYTES, "0"))) or stored(df, name)

    for op, run in ((hyperminhash, hyperminhash.near_duplicates), (line_dedup, lambda d: line_dedup.similar_lines(d, line_dedup._placed(d, "doc_id", "text")))):
        seen.clear()
        with monkeypatch.context() as m:
            m.setattr(op, "stored", recording(op.stored))
            assert "MapInArrow" not in run(docs)._jdf.queryExecution().toString()
        assert set(seen) == {common.SMALL_BATCH}
        assert spark.conf.get(common.ARROW_BYTES, None) == before


def test_batches_hold_few_bytes_and_the_setting_is_put_back(spark):
    def measured(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], ["n"])

    @common.in_small_batches
    def sizes(df):
        return [r.n for r in df.mapInArrow(measured, "n long").collect()]

    @common.in_small_batches
    def fails(df):
        raise KeyError

    wide = spark.range(0, 6000, 1, 1).selectExpr("id AS n", "repeat('x', 2000) AS text")
    before = spark.conf.get(common.ARROW_BYTES, None)
    assert len(sizes(wide)) >= 3 and max(sizes(wide)) < 2 * common.SMALL_BATCH
    with pytest.raises(KeyError):
        fails(wide)
    assert spark.conf.get(common.ARROW_BYTES, None) == before
    try:
        spark.conf.set(common.ARROW_BYTES, "1000000")  # a lower limit stays
        assert max(sizes(wide)) < 2_000_000
        assert spark.conf.get(common.ARROW_BYTES) == "1000000"
    finally:
        spark.conf.unset(common.ARROW_BYTES) if before is None else spark.conf.set(common.ARROW_BYTES, before)


def test_a_worker_keeps_small_tables_of_powers(monkeypatch):
    kept, powers = {}, hyperminhash._powers
    monkeypatch.setattr(hyperminhash, "_powers", lambda n: kept.setdefault(n, powers(n)))
    texts = [b"word " * 800] * 2000
    for _, part in hyperminhash._batches(texts, range(len(texts))):
        assert [len(x) for x in hyperminhash.shingle_sets(part, 5)] == [1] * len(part)
    assert sum(x.nbytes for pair in kept.values() for x in pair) <= 24 << 20
