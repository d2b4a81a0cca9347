"""Hand-computed edge rows, halo equivalence, plan shape of market silver."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketpulse.operators import indicators as I

SCHEMA = "ticker string, datetime timestamp_ntz, open decimal(18,2), high decimal(18,2), low decimal(18,2), close decimal(18,2), volume long"
T0 = datetime(2024, 1, 1)


def bars(spark, closes, ticker="T", highs=None, lows=None):
    rows = []
    for i, c in enumerate(closes):
        h = highs[i] if highs else c
        lo = lows[i] if lows else c
        rows.append((ticker, T0 + timedelta(hours=i), Decimal(str(c)), Decimal(str(h)),
                     Decimal(str(lo)), Decimal(str(c)), 1))
    return spark.createDataFrame(rows, SCHEMA)


def test_first_row_edges(spark):
    df = bars(spark, [10.0, 11.0, 10.5], highs=[12.0, 11.5, 11.0], lows=[9.0, 10.0, 10.0])
    r = I.with_indicators(df, strategy="partition").orderBy("datetime").collect()
    assert r[0]["PrctChange"] is None and r[0]["Direction"] == "No Change"
    assert r[0]["SMA20"] == 10.0 and r[0]["ATR"] == 3.0          # TR falls back to high - low
    assert r[1]["Direction"] == "Up" and abs(r[1]["PrctChange"] - 10.0) < 1e-12
    assert r[1]["SMA20"] == 10.5                                   # warm-up averages what exists
    assert r[2]["Direction"] == "Down"
    # gains 0, 1, 0; losses 0, 0, 0.5 -> RS = (1/3) / (0.5/3) = 2
    assert abs(r[2]["RSI"] - (100 - 100 / 3)) < 1e-9


def test_rsi_zero_loss(spark):
    df = bars(spark, [1.0, 2.0, 3.0])
    assert [x["RSI"] for x in I.add_rsi(df, ["ticker"], ["datetime"]).collect()] == [None] * 3
    r = I.add_rsi(df, ["ticker"], ["datetime"], zero_loss=100).orderBy("datetime").collect()
    assert all(x["RSI"] == 100.0 for x in r)


def test_sma_of_constant_is_constant(spark):
    r = I.add_sma(bars(spark, [7.25] * 230), ["ticker"], ["datetime"]).collect()
    assert all(x["SMA20"] == x["SMA50"] == x["SMA200"] == 7.25 for x in r)


def _cmp(a, b, key="datetime"):
    cols = [key] + I.SILVER_COLUMNS
    ra = [tuple(r[c] for c in cols) for r in a.orderBy(key).collect()]
    rb = [tuple(r[c] for c in cols) for r in b.orderBy(key).collect()]
    return ra == rb


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(min_value=1, max_value=700), chunk=st.sampled_from([199, 200, 256, 333]),
       seed=st.integers(min_value=0, max_value=10_000))
def test_halo_equals_plain(spark, n, chunk, seed):
    import random
    rnd = random.Random(seed)
    closes = [round(rnd.uniform(1, 100), 2) for _ in range(n)]
    df = bars(spark, closes)
    plain = I.with_indicators(df, strategy="partition")
    halo = I.with_indicators(df, strategy="chunked", chunk_rows=chunk)
    assert _cmp(plain, halo)


def test_halo_chunk_must_cover_lookback(spark):
    with pytest.raises(ValueError):
        I.with_indicators(bars(spark, [1.0, 2.0]), strategy="chunked", chunk_rows=10)


def test_market_silver_plan(spark):
    import __spark_entry__ as entry
    df = entry.queries()["market_silver"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # one shuffle for the bars aggregation, one shared by every indicator window
    assert plan.count("Exchange hashpartitioning") == 2


def test_auto_chunks_a_hot_ticker(spark):
    """One ticker with a third of all rows: auto switches to halo chunks once
    the largest series passes the per-task limit, with identical results."""
    import random
    rnd = random.Random(7)
    frames = [bars(spark, [round(rnd.uniform(1, 50), 2) for _ in range(n)], ticker=t)
              for t, n in [("HOT", 600), ("a", 400), ("b", 400), ("c", 400)]]
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f)
    assert I.largest_series(df, ["ticker"]) == 600
    plain = I.with_indicators(df, strategy="partition")
    auto = I.with_indicators(df, strategy="auto", series_task_limit=500, chunk_rows=256)
    plan = auto._jdf.queryExecution().optimizedPlan().toString()
    assert "_chunk" in plan
    cols = ["ticker", "datetime"] + I.SILVER_COLUMNS
    assert sorted(tuple(r) for r in plain.select(*cols).collect()) == \
        sorted(tuple(r) for r in auto.select(*cols).collect())


def test_one_second_is_split_into_equal_chunks(spark):
    """A series with all its rows in one second, told apart by a tie breaker."""
    df = bars(spark, [float(i * 37 % 101 + 1) for i in range(1500)]).withColumn(
        "tie", F.unix_seconds(F.col("datetime").cast("timestamp"))).withColumn("datetime", F.lit(T0).cast("timestamp_ntz"))
    order = ["datetime", "tie"]
    sizes = []

    def compute(frame, keys, cols):
        sizes.extend(r["n"] for r in frame.filter("_copy = 0").groupBy("_chunk").agg(
            F.count(F.lit(1)).alias("n")).orderBy("_chunk").collect())
        return I.add_all(frame, keys, cols)

    got = I.chunked(df, ["ticker"], order, compute, I.lookback_rows(), chunk_rows=400)
    assert sizes == [400, 400, 400, 300]
    placed = I.placed(df, ["ticker"], order)
    assert placed.select("_part").distinct().count() > 1
    assert [r["tie"] for r in placed.orderBy("_place").collect()] == sorted(r["tie"] for r in df.collect())
    assert _cmp(I.with_indicators(df, order_cols=order, strategy="partition"), got, "tie")


def test_full_ties_keep_every_row(spark):
    """Rows that the order does not tell apart: none lost, none doubled."""
    df = bars(spark, [5.0] * 900).withColumn("datetime", F.lit(T0).cast("timestamp_ntz"))
    got = I.with_indicators(df, strategy="chunked", chunk_rows=200)
    assert got.count() == 900 and got.agg(F.min("SMA200"), F.max("SMA200")).first() == (5.0, 5.0)
    assert got.filter("PrctChange is null").count() == 1


def test_prices_of_any_magnitude_in_doubles(spark):
    """Floating prices against means added up in Python, nulls skipped, also
    far from 1 and side by side with very large ones."""
    import math
    prices = [None if i % 23 == 7 else (1e-10 if i < 260 else 1e15) * (1 + i % 13) for i in range(520)]
    df = spark.createDataFrame([("T", i, p) for i, p in enumerate(prices)], "ticker string, at long, close double")
    df = df.withColumns({"high": F.col("close"), "low": F.col("close")})
    plain = I.with_indicators(df, order_cols=["at"], strategy="partition").orderBy("at").collect()
    assert plain[1]["PrctChange"] == pytest.approx(100.0)
    for n, name in ((20, "SMA20"), (50, "SMA50"), (200, "SMA200")):
        for i, r in enumerate(plain):
            seen = [p for p in prices[max(0, i - n + 1): i + 1] if p is not None]
            assert r[name] == pytest.approx(math.fsum(seen) / len(seen), rel=1e-12), (name, i)
    chunks = I.with_indicators(df, order_cols=["at"], strategy="chunked", chunk_rows=200)
    assert _cmp(I.with_indicators(df, order_cols=["at"], strategy="partition"), chunks, "at")


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(gaps=st.lists(st.integers(min_value=0, max_value=45), min_size=250, max_size=900),
       chunk=st.sampled_from([200, 230, 300, 512]), seed=st.integers(min_value=0, max_value=999))
def test_halo_with_uneven_buckets(spark, gaps, chunk, seed):
    """Buckets with 0..many rows each (ticks minutes apart, hourly buckets)."""
    import random
    rnd = random.Random(seed)
    rows, t = [], T0
    for i, g in enumerate(gaps):
        t = t + timedelta(minutes=g, seconds=1)
        c = Decimal(str(round(rnd.uniform(1, 100), 2)))
        rows.append(("T", t, c, c, c, c, 1))
    df = spark.createDataFrame(rows, SCHEMA)
    plain = I.with_indicators(df, strategy="partition")
    halo = I.with_indicators(df, strategy="chunked", chunk_rows=chunk)
    assert _cmp(plain, halo)


def test_null_times_and_keys_stay_in_chunks(spark):
    import random
    rnd = random.Random(5)
    closes = [Decimal(str(round(rnd.uniform(1, 90), 2))) for _ in range(700)]
    rows = [(None if k % 90 == 3 else "T", None if k % 50 == 7 else T0 + timedelta(seconds=40 * k),
             c, c, c, c, k) for k, c in enumerate(closes)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = I.with_indicators(df, order_cols=["datetime", "volume"], strategy="partition")
    auto = I.with_indicators(df, order_cols=["datetime", "volume"], series_task_limit=100, chunk_rows=256)
    assert plain.count() == auto.count() == 700
    assert _cmp(plain, auto, "volume")


def test_a_run_of_nulls_has_no_mean(spark):
    closes = [None] * 3 + [Decimal(k) for k in range(1, 30)] + [None] * 30 + [Decimal(7)]
    rows = [("T", T0 + timedelta(hours=k), c, c, c, c, 1) for k, c in enumerate(closes)]
    got = [r.SMA20 for r in I.add_sma(spark.createDataFrame(rows, SCHEMA), ["ticker"], ["datetime"])
           .orderBy("datetime").collect()]
    for k in range(len(closes)):
        have = [float(c) for c in closes[max(0, k - 19): k + 1] if c is not None]
        assert got[k] == (sum(have) / len(have) if have else None)


def test_small_prices_keep_their_places(spark):
    rows = [("T", T0 + timedelta(hours=k), 0.0012 + k / 1e4) for k in range(5)]
    df = spark.createDataFrame(rows, "ticker string, datetime timestamp_ntz, close double")
    last = I.add_pct_change(I.add_sma(df, ["ticker"], ["datetime"]), ["ticker"], ["datetime"]).orderBy("datetime").collect()[-1]
    assert abs(last.SMA20 - 0.0014) < 1e-12 and last.Direction == "Up"
