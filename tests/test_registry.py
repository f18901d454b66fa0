"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from devicelens import registry

from conftest import SF_SMALL

TABLES = ["events", "lineitem"]
NAMES = sorted(registry.ORACLE)


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "usual_data_rate" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(entry.queries())


def test_values_are_the_librarys(spark):
    """Registered largest and smallest values are those of the analysis, to the last digit."""
    from devicelens import fixtures as fx
    from devicelens.operators import bucket_stats

    plain = bucket_stats(fx.lineitem_readings(spark, SF_SMALL), registry.LI_S, registry.LI_E, registry.LI_PARTS)
    got = registry.q_bucket_stats_lineitem(spark, SF_SMALL)
    cols = ["bucket_start", "max_value", "min_value", "usual_data_rate"]
    assert sorted(map(tuple, plain.select(cols).collect())) == sorted(map(tuple, got.select(cols).collect()))
