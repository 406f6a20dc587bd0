"""Every registered query against its DuckDB oracle (order-insensitive)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from eventflow.plans.registry import QUERIES
from eventflow.plans.oracle_check import compare, duckdb_con
from tests.conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_con(SF_SMALL)


def test_every_query_has_an_oracle():
    missing = [n for n in NAMES if n not in oracle_sql()]
    assert missing == []


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name, small_blocks):
    got = queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["window_end", "item_id", "view_count", "rank"]
    assert df.count() > 0
