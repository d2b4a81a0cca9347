"""Indexed inserts, late ticks, freshness, previous close after a lost
checkpoint, and picks with nulls and ties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketpulse.functions.picking import pick
from marketpulse.operators import bars as B
from marketpulse.operators import star as T
from marketpulse.operators.ingest import duplicate_keys, keep_first
from marketpulse.session import scratch_path
from marketpulse.sources import key_index
from marketpulse.sources.files import Files
from marketpulse.sources.key_index import IndexedTable
from marketpulse.streaming import freshness as W
from marketpulse.streaming import jobs as J
from marketpulse.streaming import late as L

from testdata_paths import SF_SMALL

T0 = dt.datetime(2024, 1, 1, 10)


def rows(spark, keys, value=0):
    return spark.createDataFrame([(k, f"k{k}", value) for k in keys], "id long, name string, value int").coalesce(2)


def table(spark, **options):
    return IndexedTable(spark, scratch_path(spark, "it"), ["id", "name"], **options)


# --- key index ------------------------------------------------------------------------

def test_indexed_insert_counts_and_repeats(spark):
    t = table(spark)
    bad = spark.createDataFrame([(None, "a", 1), (1, "", 1), (1, None, 1)], "id long, name string, value int")
    one = t.insert(rows(spark, range(30)).union(rows(spark, range(10), 5)).union(bad), ["value"])
    assert (one["consumed"], one["inserted"], one["keyless"]) == (43, 30, 3)
    two = t.insert(rows(spark, range(20, 50), 7))
    assert (two["consumed"], two["inserted"]) == (30, 20)
    got = {r["id"]: r["value"] for r in t.read().collect()}
    assert got == {k: 0 if k < 30 else 7 for k in range(50)}
    assert t.insert(rows(spark, []))["consumed"] == 0
    assert t.insert(rows(spark, range(50)))["inserted"] == 0 and t.read().count() == 50


def test_indexed_insert_equals_a_set(spark):
    rng, t, stored = random.Random(1), table(spark, bucket_keys=20), set()
    for n in range(5):
        keys = [rng.randrange(900) for _ in range(140)]
        done = t.insert(rows(spark, keys, n))
        assert done["inserted"] == len(set(keys) - stored)
        stored |= set(keys)
    assert {r["id"] for r in t.read().collect()} == stored
    assert duplicate_keys(t.read(), ["id", "name"]).count() == 0
    assert t.meta()["keys"] == len(stored) and t.meta()["bits"] > 4      # it has grown


def test_bytes_read_for_a_batch_do_not_grow_with_the_table(spark):
    t, cost = table(spark, bucket_keys=250), []
    for many in (4_000, 32_000):
        t.insert(rows(spark, range(many)))
        done = t.insert(rows(spark, range(-5 - many, -many)))          # five new keys
        cost.append(done["index_bytes"])
        whole = sum(sum(Files(spark).sizes(t._folder(t.meta()["bits"], b)).values()) for b in range(2 ** t.meta()["bits"]))
    assert cost[1] <= 1.5 * cost[0] and cost[1] < 0.2 * whole


def test_many_small_batches_are_put_together(spark, monkeypatch):
    monkeypatch.setattr(key_index, "RUNS", 2)
    t = table(spark)
    for n in range(5):
        t.insert(rows(spark, range(40 * n, 40 * n + 40)))
    files = [len(Files(spark).sizes(t._folder(4, b))) for b in range(16)]
    assert max(files) <= 3 and t.read().count() == 200
    assert t.insert(rows(spark, range(200)))["inserted"] == 0


def test_bloom_filters_are_written(spark):
    t = table(spark)
    t.insert(rows(spark, range(300)))
    path = next(p for b in range(16) for p in Files(spark).sizes(t._folder(4, b)))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    columns = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in reader.getFooter().getBlocks().get(0).getColumns()}
    reader.close()
    assert columns["_hash"] > 0 and columns["id"] <= 0


def test_a_replayed_batch_replaces_its_own(spark):
    t = table(spark)
    for _ in range(2):
        assert t.insert(rows(spark, range(40)), token="q-0")["inserted"] == 40
    assert t.read().count() == 40
    assert t.insert(rows(spark, range(40)), token="other-0")["inserted"] == 0


@pytest.mark.parametrize("whole", [True, False])
def test_a_batch_cut_off_before_its_index_is_finished_by_the_next(spark, whole):
    t = table(spark)
    t.insert(rows(spark, range(10)), token="a")
    rows(spark, range(10, 30)).write.parquet(f"{t.rows}/batch=b")
    if not whole:
        t.files.delete(f"{t.rows}/batch=b/_SUCCESS")
    t.files.write(t._record, "b")
    done = t.insert(rows(spark, range(5, 40)), token="c")
    assert done["inserted"] == (10 if whole else 30)
    assert sorted(r["id"] for r in t.read().collect()) == list(range(40))
    assert not t.files.exists(t._record)


def test_indexed_stream_after_a_lost_checkpoint(spark):
    from marketpulse.plans.streams import run_indexed_insert
    t, counts = run_indexed_insert(spark, SF_SMALL, bucket_keys=100)
    n = t.read().select("ticker", "datetime", "tie_key").distinct().count()
    assert t.read().count() == n == sum(c["inserted"] for c in counts)
    assert counts[-1]["inserted"] == 0 and counts[-1]["consumed"] > n


# --- late ticks --------------------------------------------------------------------------

def ticks(spark, some):
    return spark.createDataFrame([("A", None if m is None else T0 + dt.timedelta(minutes=m), k, float(p), v)
                                  for m, k, p, v in some], "ticker string, datetime timestamp, tie_key long, price double, volume long")


def test_late_ticks_correct_exactly_their_bars(spark):
    s = L.BarStore(spark, scratch_path(spark, "bs"))
    batches = [[(5, 1, 10, 1), (50, 2, 12, 1)], [(200, 3, 20, 1)], [(2, 4, 9, 5), (59, 5, 30, 5), (None, 6, 1, 1), (210, 7, 21, 1)],
               [(24 * 60, 8, 1, 1)], [(130, 9, 7, 2)]]
    for n, b in enumerate(batches):
        done = s.update(ticks(spark, b), f"q-{n}")
        again = s.update(ticks(spark, b), f"q-{n}")       # a replay after the commit
        assert again == done
    got = {r["datetime"]: tuple(r)[2:] for r in s.closed().collect()}
    assert got[T0 + dt.timedelta(hours=1)] == (9.0, 30.0, 9.0, 30.0, 12)
    assert got[T0 + dt.timedelta(hours=3)] == (7.0, 7.0, 7.0, 7.0, 2)      # a bar that only late ticks have
    assert (done["late"], done["untimed"], done["corrected"]) == (3, 1, 2)
    assert sorted(r["tie_key"] for r in s.late(ticks(spark, batches[0]).schema).collect()) == [4, 5, 9]
    assert spark.read.parquet(f"{s.path}/untimed").count() == 1
    want = B.ohlcv_bars(ticks(spark, [t for b in batches for t in b]))
    want = want.filter(F.unix_micros("datetime") <= done["watermark"])
    cols = ["ticker", "datetime", "open", "high", "low", "close", "volume"]
    assert s.closed().select(cols).exceptAll(want.select(cols)).count() == 0 and s.closed().count() == want.count()


def test_a_batch_that_failed_before_its_commit_changes_nothing(spark):
    s = L.BarStore(spark, scratch_path(spark, "bs"))
    first, late = [(5, 1, 10, 1), (200, 2, 20, 1)], [(6, 3, 11, 4), (400, 4, 1, 1)]
    s.update(ticks(spark, first), "q-0")
    s.update(ticks(spark, [(201, 9, 5, 1)]), "q-1")
    before = s.manifest()
    s.files.write(f"{s.path}/keep.json", "{}")
    write, s.files.write = s.files.write, lambda *a: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        s.update(ticks(spark, late), "q-2")
    s.files.write = write
    assert s.manifest() == before
    s.update(ticks(spark, late), "q-2")
    bar = s.closed().filter(F.col("datetime") == F.lit(T0 + dt.timedelta(hours=1))).first()
    assert bar["volume"] == 5 and s.manifest()["late"] == 1


def test_only_touched_days_are_written_anew(spark):
    s = L.BarStore(spark, scratch_path(spark, "bs"))
    s.update(ticks(spark, [(d * 1440, d, 1, 1) for d in range(5)]), "q-0")
    s.update(ticks(spark, [(6 * 1440, 9, 1, 1)]), "q-1")
    before = s.manifest()["days"]
    s.update(ticks(spark, [(2 * 1440 + 1, 10, 3, 1)]), "q-2")
    after = s.manifest()["days"]
    assert [d for d in after if after[d] != before.get(d)] == ["2024-01-03"]


# --- freshness ------------------------------------------------------------------------------

def test_a_silent_source_turns_stale_without_a_row(spark):
    src, out, chk = (scratch_path(spark, f"f-{k}") for k in ("in", "out", "chk"))
    schema = "stream string, datetime timestamp"

    def at(name, minute):
        return name, None if minute is None else T0 + dt.timedelta(minutes=minute)

    for part in ([at("a", 0), at("b", 0), at("c", None)], [at("a", 8)], [at("a", 15)], [at("a", 20)], [at("b", 21), at("c", 1)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(src)
        W.follow_freshness(spark, W.freshness_stream(J.read_stream(spark, src, spark.createDataFrame([], schema).schema)), out, chk)
    told = {}
    for r in spark.read.parquet(out).orderBy("n").collect():
        told.setdefault(r["stream"], []).append(r["status"])
    assert set(told["a"]) == {"OK"}
    assert told["b"] == ["OK", "STALE", "OK"]        # by its timer, then by a row
    assert told["c"] == ["NO DATA", "STALE"]
    now = {r["stream"]: tuple(r)[1:] for r in W.current(spark.read.parquet(out), T0 + dt.timedelta(minutes=21)).collect()}
    assert now == {"a": (1.0, "OK"), "b": (0.0, "OK"), "c": (20.0, "STALE")}


# --- previous close ----------------------------------------------------------------------------

def test_previous_close_after_a_lost_checkpoint(spark):
    """Three bars; then the checkpoint is lost and three more arrive: all six
    are stored, none twice, and the fourth knows the third."""
    src, out, state = (scratch_path(spark, f"lc-{k}") for k in ("in", "out", "last"))
    schema = "ticker string, datetime timestamp, open double, high double, low double, close double, volume long"
    for n in range(2):
        spark.createDataFrame([("A", T0 + dt.timedelta(hours=k), 1.0, 1.0, 1.0, float(k + 1), 1)
                               for k in range(3 * n, 3 * n + 3)], schema).coalesce(1).write.mode("append").parquet(src)
        bars = J.read_stream(spark, src, spark.createDataFrame([], schema).schema)
        J.append_lagged(spark, bars, out, state, scratch_path(spark, f"lc-chk{n}"))
    got = spark.read.parquet(out).orderBy("datetime").collect()
    assert [r["close"] for r in got] == [1, 2, 3, 4, 5, 6]
    assert got[3]["PrctChange"] == pytest.approx(100 / 3) and got[0]["PrctChange"] is None


# --- picks, star, bars ------------------------------------------------------------------------------

def test_nulls_in_the_ordering_lose_and_ties_are_settled(spark):
    kinds = {"long": [1, 2, None], "date": [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None],
             "timestamp": [T0, T0 + dt.timedelta(1), None], "double": [1.5, 2.5, None], "string": ["a", "b", None]}
    for kind, (a, b, none) in kinds.items():
        data = [("x", none, 1, "p"), ("x", b, 2, "q"), ("x", a, 3, "r"), ("y", none, 4, "s"), ("z", a, 5, "t"), ("z", a, 6, "u")]
        for values in (["v"], ["v", "w"]):
            picked = set()
            for seed in range(3):
                some = random.Random(seed).sample(data, len(data))
                df = spark.createDataFrame(some, f"k string, o {kind}, v int, w string").repartition(3)
                first = {r["k"]: r["v"] for r in pick(df, ["k"], ["o"], values, last=False).collect()}
                last = {r["k"]: r["v"] for r in pick(df, ["k"], ["o"], values).collect()}
                assert (first["x"], last["x"], first["y"], last["y"]) == (3, 2, 4, 4)
                picked.add((first["z"], last["z"]))
            assert len(picked) == 1
    two = spark.createDataFrame([("a", None, 1), ("a", None, 2)], "key string, arrival long, v int")
    assert keep_first(two, ["key"], ["arrival"]).first()["v"] in (1, 2)


def test_facts_without_a_time_and_renamed_authors_are_counted_once(spark):
    fact = spark.createDataFrame([("A", T0, 1.0, 1.0, 1.0, 1), ("A", None, 3.0, 3.0, 3.0, 1)],
                                 "ticker string, datetime timestamp, close double, high double, low double, volume long")
    r = T.market_rollup(fact, T.time_dim(fact)).collect()
    assert sum(x["n_bars"] for x in r) == 2 and {x["year"] for x in r} == {2024, None}
    posts = spark.createDataFrame([("t2_1", 1.0, 1.0, 5)], "author_fullname string, VaderScore double, TextblobScore double, score long")
    dim = spark.createDataFrame([("old", "t2_1", True, False), ("new", "t2_1", False, False), (None, None, True, True)],
                                "author string, author_fullname string, author_verified boolean, author_is_gold boolean")
    assert [x["n_posts"] for x in T.sentiment_by_author(posts, dim).collect()] == [1]


def test_ticks_without_a_time_make_a_bar_of_their_own(spark):
    bars = {r["datetime"]: r["volume"] for r in B.ohlcv_bars(ticks(spark, [(0, 1, 1, 1), (None, 2, 1, 4), (None, 3, 2, 4)])).collect()}
    assert bars == {T0 + dt.timedelta(hours=1): 1, None: 8}
