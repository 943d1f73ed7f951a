"""Every registered query against its DuckDB twin (small scale factor), and
the driver entry points."""

import pytest

import __spark_entry__ as E
from cartwheel.plans import oracle, registry
from conftest import SF_SMALL
from oracle_check import compare, duck

# the optional training-data queries have tests of their own
QUERIES = registry.queries()
ORACLES = oracle.oracle_sql()
BATCH = [n for n in QUERIES if not n.startswith("stream_")]
STREAM = [n for n in QUERIES if n.startswith("stream_")]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["hour", "today", "yesterday"] and len(rows) == 24


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(ORACLES)
    assert rows_only == set()
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", BATCH)
def test_batch_query_matches_oracle(spark, con, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, SF_SMALL).count() >= 0
        return
    ok, n, _, _, msg = compare(spark, name, QUERIES[name], ORACLES[name], SF_SMALL, con)
    assert ok, msg


@pytest.mark.parametrize("name", STREAM)
def test_stream_query_matches_oracle(spark, con, name):
    ok, n, _, _, msg = compare(spark, name, QUERIES[name], ORACLES[name], SF_SMALL, con)
    assert ok, msg
