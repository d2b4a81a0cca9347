"""Profile versions, sketches, publishing with outcomes, writes with a unique key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketpulse.operators import sketches as K
from marketpulse.operators import social as P
from marketpulse.operators import versions as V
from marketpulse.session import scratch_path
from marketpulse.sources import topics
from marketpulse.sources.sinks import append_unique

T0 = dt.datetime(2024, 1, 1)


def day(k):
    return T0 + dt.timedelta(days=k)


def test_versions_are_changes(spark):
    rows = [("a", day(0), 1, None), ("a", day(5), 1, None), ("a", day(9), 2, "x"), ("a", day(20), 1, None), ("b", day(3), 7, "y"),
            ("b", day(3), 7, "y"), (None, day(1), 1, "z"), ("c", None, 1, "z")]
    h = V.versions(spark.createDataFrame(rows, "k string, t timestamp, v int, w string"), "k", "t", ["v", "w"])
    got = sorted((r["k"], r["valid_from"], r["valid_to"], r["v"], r["w"]) for r in h.collect())
    assert got == [("a", day(0), day(9), 1, None), ("a", day(9), day(20), 2, "x"), ("a", day(20), None, 1, None),
                   ("b", day(3), None, 7, "y")]


def test_as_of_equals_a_search(spark):
    """One key holds most events; versions and events meet at the same moment."""
    rng = random.Random(3)
    snaps = [(k, day(rng.randrange(0, 400)), rng.randrange(3)) for k in ("hot", "b", "c") for _ in range(12)]
    events = [(n, rng.choice(["hot"] * 8 + ["b", "c", "none", None]), rng.choice([day(rng.randrange(-20, 500)), snaps[n % 36][1], None]), -1)
              for n in range(600)]
    h = V.versions(spark.createDataFrame(snaps, "k string, t timestamp, v int"), "k", "t", ["v"])
    valid = [(r["k"], r["valid_from"], r["valid_to"], r["v"]) for r in h.collect()]
    e = spark.createDataFrame(events, "n int, k string, t timestamp, v int").repartition(3)
    for bucket in ("month", "year"):
        got = {r["n"]: r["v"] for r in V.as_of(e, h, "k", "t", ["v"], bucket).collect()}
        assert len(got) == len(events)
        for n, k, t, _ in events:
            found = [v for key, a, b, v in valid if key == k and t is not None and a <= t and (b is None or t < b)]
            assert got[n] == (found[0] if found else None)
    none = spark.createDataFrame([], "n int, k string, t timestamp")
    assert V.as_of(none, h, "k", "t", ["v"]).count() == 0
    assert V.as_of(e, h.limit(0), "k", "t", ["v"]).filter("v is not null").count() == 0


def test_sketches_of_days_add_up(spark):
    rows = spark.range(60_000).select(F.concat(F.lit("u"), F.col("id") % 20_000).alias("who"),
                                      F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"),
                                      F.timestamp_seconds(F.col("id") * 30).alias("t"))
    rows = rows.union(rows.limit(1).select(F.lit(None).cast("string"), "g", "t"))
    daily = K.daily(rows, ["g"], "who", "t").cache()
    exact = {r["g"]: r["n"] for r in K.exact(rows, ["g"], "who").collect()}
    for r in K.estimated(daily, ["g"]).collect():
        assert abs(r["n"] - exact[r["g"]]) <= 4 * K.error() * exact[r["g"]]
    assert abs(K.estimated(daily).first()["n"] - 20_000) <= 4 * K.error() * 20_000
    half = K.merged(daily.filter("day < '1970-01-10'"), ["g"]).unionByName(K.merged(daily.filter("day >= '1970-01-10'"), ["g"]))
    assert sorted(K.estimated(half, ["g"]).collect()) == sorted(K.estimated(daily, ["g"]).collect())
    daily.unpersist()


def test_publish_says_what_became_of_each_record(spark):
    rows = [("1", "a"), ("2", "b" * 200), (None, "c"), ("", "d"), ("5", None), ("6", "é" * 30)]
    df = spark.createDataFrame(rows, "k string, v string")
    sent, dead = scratch_path(spark, "sent"), scratch_path(spark, "dead")
    told = topics.publish_batch(df, dead, "k", "t", ["v"], "parquet", {"path": sent}, largest=60)
    assert told == {"sent": 1, "no key": 2, "not encoded": 1, "too large": 2}
    assert [tuple(r) for r in spark.read.parquet(sent).select("key", "value", "topic").collect()] == [("1", '{"v":"a"}', "t")]
    assert sorted((r["key"] or "", r["reason"]) for r in spark.read.parquet(dead).collect()) == [
        ("", "no key"), ("", "no key"), ("2", "too large"), ("5", "not encoded"), ("6", "too large")]


def test_unique_keys_are_enforced_by_the_write(spark):
    path = scratch_path(spark, "unique")
    make = lambda rows: spark.createDataFrame(rows, "a string, b long, v int").repartition(3)
    append_unique(spark, make([("x", 1, 1), ("x", 2, 2), ("y", 1, 3)]), path, ["a", "b"])
    for bad, said in (([("z", 1, 1), ("z", 2, 1), ("z", 1, 2)], "key occurs twice: z, 1"), ([("q", 1, 1), ("y", 1, 9)], "key occurs twice: y, 1"),
                      ([("q", None, 1)], "no key: q, null"), ([("", 3, 1), ("r", 1, 1)], "no key")):
        with pytest.raises(Exception, match=said):
            append_unique(spark, make(bad), path, ["a", "b"])
        assert spark.read.parquet(path).count() == 3
    append_unique(spark, make([("z", 1, 1)]), path, ["a", "b"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 1, 2, 3]


def test_summary_of_a_range_from_one_scan(spark):
    posts = spark.createDataFrame([("a", 10), ("a", 20), ("b", 30), ("x", 15), (None, 15), ("b", None)], "subreddit string, created_utc long")
    out = P.run_summary(posts, ["a", "b", "c"], 10, 25)
    assert {r["subreddit"]: r["n_posts"] for r in out.collect()} == {"a": 2, "b": 0, "c": 0, "ALL": 2}
    assert {r["subreddit"]: r["n_posts"] for r in P.run_summary(posts, ["a", "b"]).collect()} == {"a": 2, "b": 2, "ALL": 4}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2 and "Join" not in plan
