"""Every registered query against its SQL oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from compare import compare

from testdata_paths import SF_SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def test_every_query_of_the_library_has_an_oracle():
    from marketpulse.plans import QUERIES as own
    assert set(own) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck_small, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck_small.sql(ORACLES[name]).df()
    ok, msg = compare(name, got, want)
    assert ok, msg


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "RSI" in df.columns and "SMA200" in df.columns
