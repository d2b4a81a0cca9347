"""Batch/stream equivalence with a restart from the checkpoint midway."""

from pyspark.sql import functions as F

from marketpulse.operators import bars as B
from marketpulse.operators import social as P
from marketpulse.session import scratch_path
from marketpulse.sources import fixtures as X
from marketpulse.streaming import jobs as J

from testdata_paths import SF_SMALL


def test_bars_stream_restart_equals_batch(spark):
    """Ticks arrive in four slices; the query is restarted from its checkpoint
    after each one (availableNow), and the closed bars equal batch."""
    ticks = X.ticks(spark, SF_SMALL).withColumn("datetime", F.col("datetime").cast("timestamp"))
    src, out, chk = scratch_path(spark, "t-src"), scratch_path(spark, "t-out"), scratch_path(spark, "t-chk")

    def once():
        J.append_stream(J.bars_stream(J.read_stream(spark, src, ticks.schema)), out, chk)

    J.feed_in_order(ticks, src, J.time_slice(ticks, "datetime", 4), 4, once)
    got = spark.read.parquet(out)
    max_ts = ticks.agg(F.max("datetime")).first()[0]
    want = B.ohlcv_bars(ticks, "1 hour").filter(
        F.col("datetime") <= F.lit(max_ts) - F.expr("interval 15 minutes"))
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_stream_insert_target_has_unique_keys(spark):
    import __spark_entry__ as entry
    from marketpulse.operators.ingest import duplicate_keys
    t = entry.queries()["stream_insert_new"](spark, SF_SMALL)
    assert t.count() == X.ticks(spark, SF_SMALL).count()
    assert duplicate_keys(t, ["ticker", "datetime", "tie_key"]).count() == 0


def test_previous_close_equals_batch(spark):
    import __spark_entry__ as entry
    got = entry.queries()["stream_pct_change"](spark, SF_SMALL)
    batch = entry.queries()["financial_fact_stream_shape"](spark, SF_SMALL)
    assert got.count() > 0
    assert got.exceptAll(batch.select(*got.columns)).count() == 0


def test_post_stream_counts_what_it_stores(spark):
    from marketpulse.plans.streams import run_posts_stream
    out, schema, counts = run_posts_stream(spark, SF_SMALL)
    c = spark.read.parquet(counts).agg(F.sum("consumed"), F.sum("inserted"), F.sum("errors")).first()
    posts = X.posts(spark, SF_SMALL)
    again = posts.filter(F.col("id").cast("long") % 7 == 0).count()
    assert tuple(c) == (posts.count() + again, posts.count(), 0)
    assert spark.read.schema(schema).parquet(out).select("id").distinct().count() == posts.count()


def test_old_posts_are_stored_whenever_they_arrive(spark):
    """Posts hours and days older than the newest one, in a later batch."""
    from marketpulse.plans.social import enriched_posts
    e = enriched_posts(spark, SF_SMALL).limit(5)
    rows = P.parse_created(e, out="_t").orderBy(F.col("_t").desc()).collect()
    src, out, chk = scratch_path(spark, "o-in"), scratch_path(spark, "o-out"), scratch_path(spark, "o-chk")
    for part in (rows[:2], rows[1:]):
        spark.createDataFrame(part, P.parse_created(e, out="_t").schema).drop("_t").write.mode("append").parquet(src)
        J.score_posts_stream(spark, J.read_stream(spark, src, e.schema), out, chk)
    assert spark.read.parquet(out).select("id").distinct().count() == len(rows) == spark.read.parquet(out).count()


def test_rows_without_a_time_are_fed(spark):
    ticks = X.ticks(spark, SF_SMALL).withColumn(
        "datetime", F.when(F.col("tie_key") % 10 != 3, F.col("datetime").cast("timestamp")))
    src, seen = scratch_path(spark, "nt-in"), []
    J.feed_in_order(ticks, src, J.time_slice(ticks, "datetime", 3), 3,
                    lambda: seen.append(spark.read.parquet(src).count()))
    assert seen[-1] == ticks.count() and len(seen) == 3 and seen[0] < seen[1] < seen[2]


def test_previous_close_batches_survive_a_replay(spark):
    """Every batch again from a fresh checkpoint: nothing is written twice."""
    bars = B.ohlcv_bars(X.ticks(spark, SF_SMALL).withColumn("datetime", F.col("datetime").cast("timestamp")), "1 hour")
    src, out, state = scratch_path(spark, "pc-in"), scratch_path(spark, "pc-out"), scratch_path(spark, "pc-last")
    bars.write.parquet(src)
    for k in range(2):
        J.append_lagged(spark, J.read_stream(spark, src, bars.schema), out, state, scratch_path(spark, f"pc-{k}"))
    got = spark.read.parquet(out)
    assert got.count() == bars.count()
    plan = J.with_previous_close(bars, bars)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_listener_collects_progress(spark):
    import time
    from marketpulse.plans.social import enriched_posts
    from marketpulse.streaming.monitor import ProgressCollector
    listener = ProgressCollector()
    spark.streams.addListener(listener)
    try:
        src, out = scratch_path(spark, "l-posts"), scratch_path(spark, "l-out")
        e = enriched_posts(spark, SF_SMALL)
        e.write.parquet(src)
        q = J.append_stream(J.posts_stream(J.read_stream(spark, src, e.schema)), out,
                            scratch_path(spark, "l-chk"))
        n = e.count()
        for _ in range(50):
            if listener.summary(str(q.id))["input_rows"] >= n:
                break
            time.sleep(0.2)
        s = listener.summary(str(q.id))
        assert s["input_rows"] == n and s["observed"]["ingest"]["consumed"] == n
    finally:
        spark.streams.removeListener(listener)


def test_previous_close_restarts_from_its_checkpoint(spark):
    """Bars and previous-close jobs run on a slice of the ticks, stop, and
    resume from their checkpoints with the rest: equal to batch."""
    import __spark_entry__ as entry
    ticks = X.ticks(spark, SF_SMALL).withColumn("datetime", F.col("datetime").cast("timestamp"))
    src = scratch_path(spark, "r-src")
    bars_out, bars_chk = scratch_path(spark, "r-bars"), scratch_path(spark, "r-bars-chk")
    out, state, chk = (scratch_path(spark, f"r-{k}") for k in ("lag", "last", "lag-chk"))

    def run_both():
        bars = J.bars_stream(J.read_stream(spark, src, ticks.schema))
        J.append_stream(bars, bars_out, bars_chk)
        J.append_lagged(spark, J.read_stream(spark, bars_out, bars.schema), out, state, chk)

    J.feed_in_order(ticks, src, J.time_slice(ticks, "datetime", 3), 3, run_both)
    got = spark.read.parquet(out).select(
        "ticker", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "PrctChange", "Direction")
    want = entry.queries()["stream_pct_change"](spark, SF_SMALL).select(*got.columns)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_route_stream_replay_is_idempotent(spark):
    """Replaying every micro-batch (fresh checkpoint, same targets) rewrites
    each batch's output instead of appending a second copy."""
    from marketpulse.plans.ops import MARKET_MSG, POST_MSG
    msgs = X.messages(spark, SF_SMALL)
    src = scratch_path(spark, "rr-in")
    msgs.repartition(3).write.parquet(src)
    targets = {"market": scratch_path(spark, "rr-m"), "posts": scratch_path(spark, "rr-p")}
    schemas = {"market": MARKET_MSG, "posts": POST_MSG}
    for attempt in range(2):
        J.route_stream(spark, J.read_stream(spark, src, msgs.schema), schemas, targets,
                       scratch_path(spark, f"rr-chk{attempt}"))
    from marketpulse.operators import ingest as G
    got = sum(spark.read.schema(schemas[t]).parquet(targets[t]).count() for t in schemas)
    assert got == msgs.count() - G.rejects(msgs, schemas).count() < msgs.count()
