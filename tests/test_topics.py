"""Topic source and sink options; message shape. No broker is needed."""

import pytest
from pyspark.sql import functions as F

from marketpulse.operators import ingest as G
from marketpulse.operators import social as P
from marketpulse.sources import tables, topics


def test_source_options():
    o = topics.source_options(["a:1", "b:2"], ["market", "posts"], "latest", 500, "mp")
    assert o == {"kafka.bootstrap.servers": "a:1,b:2", "subscribe": "market,posts", "startingOffsets": "latest",
                 "failOnDataLoss": "true", "maxOffsetsPerTrigger": "500", "groupIdPrefix": "mp"}
    assert topics.source_options("a:1", "^market-.*")["subscribePattern"] == "^market-.*"
    with pytest.raises(ValueError):
        topics.source_options("a:1", [])


def test_sink_options():
    assert topics.sink_options("a:1", "out") == {"kafka.bootstrap.servers": "a:1", "kafka.acks": "all",
                                                 "kafka.retries": "3", "topic": "out"}
    assert "topic" not in topics.sink_options("a:1")


def test_a_source_with_its_own_schema_is_read_without_one(spark):
    s = tables.read_collection_stream(spark, None, fmt="rate", rowsPerSecond="1")
    assert s.isStreaming and s.columns == ["timestamp", "value"]


def test_a_stream_can_be_enriched(spark):
    posts = (spark.readStream.format("rate").load()
             .select(F.col("value").cast("string").alias("id"), F.lit("ann").alias("author")))
    authors = spark.createDataFrame([("ann", 3)], "author string, author_total_karma long")
    assert P.enrich(posts, authors).isStreaming


def test_date_only_normalise(spark):
    from datetime import datetime
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3), 1.005)], "Date timestamp_ntz, Open double")
    assert [tuple(r) for r in G.normalise_ohlcv(df, date_only=True).collect()] == [("2024-01-02", 1.01)]
