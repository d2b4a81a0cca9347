"""Normalisation, keep-first, insert-new, routing, unique keys."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketpulse.operators import ingest as G
from marketpulse.session import scratch_path
from marketpulse.sources.sinks import append_new


def test_normalise_rounds_half_up_and_truncates(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 2, 3, 4, 5), 0.125, 1.005, 0.994, 2.675, 10.9, 0.0, 0.0)],
        "Date timestamp_ntz, Open double, High double, Low double, Close double, Volume double, "
        "Dividends double, `Stock Splits` double")
    r = G.normalise_ohlcv(df, {"ticker": "X"}).collect()[0].asDict()
    assert r == {"datetime": "2024-01-02 03:04:05", "open": 0.13, "high": 1.01, "low": 0.99,
                 "close": 2.68, "volume": 10, "ticker": "X"}


def test_normalise_needs_a_time_column(spark):
    df = spark.createDataFrame([(1.0,)], "Open double")
    with pytest.raises(ValueError):
        G.normalise_ohlcv(df)


def test_keep_first_and_empty_keys(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 3, 0), ("", 4, 0), (None, 5, 0)],
                               "k string, v int, arrival int")
    r = sorted(tuple(x) for x in G.keep_first(df, ["k"], ["arrival"]).collect())
    assert r == [("a", 1, 0), ("b", 3, 0)]


def test_insert_new_twice_inserts_nothing(spark):
    path = scratch_path(spark, "t-insert")
    df = spark.createDataFrame([(1, "x", 0), (1, "y", 1), (2, "z", 0)], "id long, v string, arrival int")
    assert append_new(spark, df, path, ["id"], ["arrival"]) == 2
    assert append_new(spark, df, path, ["id"], ["arrival"]) == 0
    more = spark.createDataFrame([(3, "w", 0)], "id long, v string, arrival int")
    assert append_new(spark, more, path, ["id"], ["arrival"]) == 1
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["w", "x", "z"]


def test_route_counts_bad_messages(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    msgs = spark.createDataFrame([("m", '{"a": "x", "n": 1}'), ("m", "not json"), ("p", '{"a": "y"}')],
                                 "topic string, value string")
    schema = StructType([StructField("a", StringType()), StructField("n", LongType())])
    out = G.route(msgs, {"m": schema})["m"]
    rows = sorted(((r.a, r.n, r._bad) for r in out.collect()), key=lambda t: t[2], reverse=True)
    assert rows == [(None, None, True), ("x", 1, False)]
    assert [tuple(r) for r in G.rejects(msgs, {"m": schema}).orderBy("topic").collect()] == [
        ("m", "not json"), ("p", '{"a": "y"}')]


def test_messages_that_do_not_parse(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([StructField("a", StringType()), StructField("n", LongType())])
    texts = ['{"a": "x", "n": 1}', "{}", '{"a": "x"', "not json", None, '{"n": "text"}', '{"n": null}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    got = {r.i: r._bad for r in G.parse_messages(df, schema).collect()}
    assert got == {0: False, 1: False, 2: True, 3: True, 4: True, 5: True, 6: False}


def test_insert_counts_rows_without_a_key(spark):
    from marketpulse.sources.sinks import insert_new
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id long, v string")
    path = scratch_path(spark, "t-keyless")
    assert insert_new(spark, df, path, ["id"]) == {"consumed": 4, "inserted": 2, "keyless": 1}
    assert insert_new(spark, df, path, ["id"]) == {"consumed": 4, "inserted": 0, "keyless": 1}


def test_the_range_column_is_part_of_the_key(spark):
    from marketpulse.sources.sinks import new_rows
    df = spark.createDataFrame([(1, 2)], "id long, scraped_at long")
    with pytest.raises(ValueError, match="scraped_at"):
        new_rows(df, df, ["id"], range_col="scraped_at")


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in G.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]


def test_keep_first_fixed_width_is_row_consistent(spark):
    """Per-column min_by on the same arrival key never mixes two rows, even
    when arrivals tie."""
    rows = [(k, v, v * 10, a) for k in range(50) for v, a in [(1, 0), (2, 0), (3, 1), (4, 0)]]
    df = spark.createDataFrame(rows, "k long, v long, w long, arrival int").repartition(7)
    out = G.keep_first(df, ["k"], ["arrival"])
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        assert r.w == r.v * 10 and r.arrival == 0


def test_parse_bar_time_text(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02T03:04:05",), (None,)], "datetime string")
    r = [x.datetime for x in G.parse_bar_time(df).collect()]
    assert r[0] == datetime(2024, 1, 2, 3, 4, 5) and r[1] is None and r[2] is None


def test_insert_new_prunes_stored_partitions(spark):
    from marketpulse.sources import fixtures as X
    from marketpulse.sources.sinks import new_rows
    t = X.ticks(spark, "/root/testdata/sf0.001").withColumn("day", F.to_date("datetime"))
    path = scratch_path(spark, "t-pp")
    t.filter(F.col("tie_key") % 2 == 0).write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    incoming = t.withColumn("arrival", F.lit(0)).filter(F.col("datetime") >= F.lit("2024-01-03").cast("timestamp_ntz"))
    key = ["ticker", "datetime", "tie_key"]
    pruned = new_rows(incoming, stored, key, ["arrival"], range_col="datetime", partition_col="day")
    plain = new_rows(incoming, stored, key, ["arrival"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "Subquery" in plan
    assert sorted(map(tuple, pruned.select(*key).collect())) == sorted(map(tuple, plain.select(*key).collect()))
    # appending through the partitioned path inserts nothing twice
    target = scratch_path(spark, "t-pp2")
    assert append_new(spark, incoming, target, key, ["arrival"], "datetime", partition_by=["day"]) == incoming.count()
    assert append_new(spark, incoming, target, key, ["arrival"], "datetime", partition_by=["day"]) == 0
