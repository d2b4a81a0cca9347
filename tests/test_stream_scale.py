"""Streaming inserts and freshness as they run on larger tables: joins by
shuffle, replays that insert nothing, many buckets, many state partitions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketpulse.session import scratch_path
from marketpulse.sources import key_index
from marketpulse.sources.files import Files
from marketpulse.sources.sinks import insert_new
from marketpulse.streaming import freshness as W
from marketpulse.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1, 10)


@pytest.fixture
def by_shuffle(spark):
    """No join is broadcast, as on tables beyond the broadcast limit."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def days(spark, some):
    rows = [(k, T0 + dt.timedelta(days=k % 3), 0) for k in some]
    return spark.createDataFrame(rows, "id long, datetime timestamp, arrival int").withColumn(
        "day", F.to_date("datetime")).repartition(3)


# --- counts of a partitioned insert ------------------------------------------------------

def test_a_replay_into_a_partitioned_table_counts_nothing(spark, by_shuffle):
    path, key = scratch_path(spark, "pi"), ["id", "datetime"]

    def insert(some):
        return insert_new(spark, days(spark, some), path, key, ["arrival"], "datetime", partition_by=["day"])

    assert insert(range(30)) == {"consumed": 30, "inserted": 30, "keyless": 0}
    assert insert(range(30)) == {"consumed": 30, "inserted": 0, "keyless": 0}
    assert insert(range(20, 50)) == {"consumed": 30, "inserted": 20, "keyless": 0}
    assert insert([]) == {"consumed": 0, "inserted": 0, "keyless": 0}
    assert spark.read.parquet(path).select("id").distinct().count() == spark.read.parquet(path).count() == 50


def test_a_partitioned_table_may_begin_with_inserts_of_nothing(spark):
    """Batches without rows, or with rows that have no key only, before the first row."""
    path, key = scratch_path(spark, "pe"), ["id", "datetime"]
    keyless = days(spark, [1]).withColumn("id", F.lit(None).cast("long"))

    def insert(rows):
        return insert_new(spark, rows, path, key, ["arrival"], "datetime", partition_by=["day"])

    assert insert(days(spark, [])) == {"consumed": 0, "inserted": 0, "keyless": 0}
    assert insert(keyless) == {"consumed": 1, "inserted": 0, "keyless": 1}
    for n in (9, 0):
        assert insert(days(spark, range(9))) == {"consumed": 9, "inserted": n, "keyless": 0}
    assert spark.read.parquet(path).count() == 9


def test_a_replayed_stream_into_a_partitioned_table_counts_nothing(spark, by_shuffle):
    src, path = scratch_path(spark, "ps-in"), scratch_path(spark, "ps")
    rows = days(spark, range(60))
    rows.unionByName(rows.filter("id % 7 = 0").withColumn("arrival", F.lit(1))).write.parquet(src)
    got = []
    for k in range(2):
        counts = scratch_path(spark, f"ps-counts{k}")
        J.insert_new_stream(spark, J.read_stream(spark, src, rows.schema), path, scratch_path(spark, f"ps-chk{k}"),
                            ["id", "datetime"], ["arrival"], "datetime", ["day"], counts, "market")
        got.append([tuple(r) for r in spark.read.parquet(counts).select("consumed", "inserted", "errors").collect()])
    assert got == [[(69, 60, 0)], [(69, 0, 0)]]
    assert spark.read.parquet(path).count() == 60


# --- many buckets --------------------------------------------------------------------------

def test_many_buckets_are_filled_before_there_are_more(spark, monkeypatch):
    """From MANY_BITS on a bucket takes BUCKET_KEYS keys; buckets beyond LISTERS are
    listed by Spark, and put together where they have too many files."""
    for name, value in {"MANY_BITS": 4, "BUCKET_KEYS": 60, "LISTERS": 4, "RUNS": 2}.items():
        monkeypatch.setattr(key_index, name, value, raising=False)
    t = key_index.IndexedTable(spark, scratch_path(spark, "mb"), ["id"], bucket_keys=5)

    def insert(some, token=None):
        rows = spark.range(*some).withColumn("v", F.lit(0)).coalesce(2)
        return t.insert(rows, token=token)["inserted"]

    assert [insert((0, 300)), insert((200, 600)), insert((590, 900))] == [300, 300, 300]
    assert t.meta() == {"bits": 4, "keys": 900}
    assert insert((0, 900)) == 0 and insert((895, 897)) == 0
    assert max(len(t.files.sizes(t._folder(4, b))) for b in range(16)) <= 3
    assert insert((800, 1000), "q-0") == 100 and t.meta() == {"bits": 7, "keys": 1000}
    assert insert((800, 1000), "q-0") == 100        # a replay replaces its own
    assert insert((0, 1000)) == 0
    assert sorted(r["id"] for r in t.read().collect()) == list(range(1000))
    assert not t.files.exists(t._folder(4))


# --- state partitions of the freshness -----------------------------------------------------

def test_state_partitions_are_worked_on_side_by_side(spark):
    src, out = scratch_path(spark, "fp-in"), scratch_path(spark, "fp-out")
    spark.createDataFrame([(f"s{k}", T0) for k in range(20)], "stream string, datetime timestamp").coalesce(1).write.parquet(src)
    stream = J.read_stream(spark, src, spark.read.parquet(src).schema)
    q = W.follow_freshness(spark, W.freshness_stream(stream), out, scratch_path(spark, "fp-chk"))
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(str(q.runId)) for s in tracker.getJobInfo(j).stageIds}
    assert max(i.numTasks for s in stages if (i := tracker.getStageInfo(s))) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.read.parquet(out).filter("n = 0").count() == 20
    assert len(Files(spark).sizes(f"{out}/batch={q.id}-0")) == 1
