"""Star schema properties: dimensions have unique keys; facts keep their rows."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marketpulse.operators import ingest as G
from marketpulse.operators import social as P

from testdata_paths import SF_SMALL

Q = entry.queries()


@pytest.mark.parametrize("name,key", [
    ("ticker_dim", ["ticker"]), ("time_dim", ["datetime"]), ("platform_dim", ["subreddit"]),
    ("author_dim_latest", ["author"]),
])
def test_dimension_keys_are_unique(spark, name, key):
    dim = Q[name](spark, SF_SMALL)
    assert dim.count() > 0
    assert G.duplicate_keys(dim, key).count() == 0


def test_facts_keep_every_row(spark):
    silver = Q["posts_silver"](spark, SF_SMALL)
    fact = Q["sentiment_fact"](spark, SF_SMALL)
    assert fact.count() == silver.count()
    assert "author_total_karma" not in fact.columns and "author_fullname" in fact.columns


def test_malformed_creation_time_is_null_not_an_error(spark):
    df = spark.createDataFrame([("1", "2024-01-02T03:04:05"), ("2", "2024-01-02T03:04:05.123"),
                                ("3", "garbage"), ("4", None)], "id string, created_datetime string")
    r = {x.id: x.datetime for x in P.parse_created(df).collect()}
    assert r["1"] is not None and r["2"] is None and r["3"] is None and r["4"] is None
    bad = P.parse_created(df).agg(F.count_if(F.col("datetime").isNull())).first()[0]
    assert bad == 3
