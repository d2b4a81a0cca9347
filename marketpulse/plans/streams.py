"""Streaming jobs registered as queries.

Each callable stages its input (derived from the driver's tables) in slices,
runs the streaming job with ``availableNow`` after each slice, restarted from
its checkpoint, into a fresh directory under the shared checkpoint location,
and returns the produced table. Windowed outputs equal the batch answer
restricted to windows the watermark has closed (end <= max event time - 15
minutes).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketpulse.operators import ingest as G
from marketpulse.operators import social as P
from marketpulse.operators import star as T
from marketpulse.plans import oracle as O
from marketpulse.plans.catalog import register
from marketpulse.plans.ops import MARKET_MSG, MESSAGES_SQL, POST_MSG, ROUTE_SQL
from marketpulse.plans.social import SILVER_SELECT, SOCIAL, enriched_posts, silver_out
from marketpulse.session import scratch_path
from marketpulse.sources import fixtures as X
from marketpulse.sources import key_index as K
from marketpulse.streaming import freshness as W
from marketpulse.streaming import jobs as J
from marketpulse.streaming import late as L

N_SLICES = 4
_CLOSED = "datetime <= (select max(ts) from events) - interval 15 minute"
_BARS_OUT = ("select ticker, datetime, open::double as open, high::double as high, low::double as low, "
             "close::double as close, volume from bars_1h where " + _CLOSED)


def _ticks_ts(spark, sf_dir):
    return X.ticks(spark, sf_dir).withColumn("datetime", F.col("datetime").cast("timestamp"))


def _prices_double(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ["open", "high", "low", "close"]})


def run_bars_stream(spark, sf_dir, every: str = "1 hour"):
    """ticks arriving in time order -> closed bars (parquet). Returns (path, schema)."""
    src, out = scratch_path(spark, "ticks-in"), scratch_path(spark, "bars-out")
    chk = scratch_path(spark, "bars-chk")
    ticks = _ticks_ts(spark, sf_dir)
    seen = {}

    def once():
        bars = J.bars_stream(J.read_stream(spark, src, ticks.schema), every=every)
        seen["schema"] = bars.schema
        J.append_stream(bars, out, chk)

    J.feed_in_order(ticks, src, J.time_slice(ticks, "datetime", N_SLICES), N_SLICES, once)
    return out, seen["schema"]


@register("stream_bars_1h", O.with_(O.TICKS, O.BARS_1H) + _BARS_OUT)
def q_stream_bars_1h(spark, sf_dir):
    out, schema = run_bars_stream(spark, sf_dir)
    b = J.read_output(spark, out, schema)
    return _prices_double(b).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def run_silver_stream(spark, sf_dir):
    """closed bars (as a stream) -> previous close by batch -> market silver.
    Returns (path of the batches, schema)."""
    bars_path, schema = run_bars_stream(spark, sf_dir)
    out, state = scratch_path(spark, "msilver-out"), scratch_path(spark, "msilver-last")
    J.append_lagged(spark, J.read_stream(spark, bars_path, schema), out, state,
                    scratch_path(spark, "msilver-chk"))
    silver = spark.read.parquet(out).drop("batch_id")
    return f"{out}/*", silver.schema


_PCT_SQL = (O.with_(O.TICKS, O.BARS_1H)
            + ", b as (select *, lag(close) over (partition by ticker order by datetime) as prev from bars_1h where "
            + _CLOSED + ") select ticker, datetime, open::double as open, close::double as close, "
            "high::double as high, low::double as low, volume, "
            "((close - prev)::double / nullif(prev::double, 0)) * 100 as PrctChange, "
            "case when close > prev then 'Up' when close < prev then 'Down' else 'No Change' end as Direction from b")


@register("stream_pct_change", _PCT_SQL)
def q_stream_pct_change(spark, sf_dir):
    """Percent change vs the previous closed bar across micro-batches."""
    out, schema = run_silver_stream(spark, sf_dir)
    s = spark.read.schema(schema).parquet(out)
    return _prices_double(s).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


@register("stream_financial_fact", _PCT_SQL)
def q_stream_financial_fact(spark, sf_dir):
    """Gold: the silver stream projected to the fact columns (a third query)."""
    silver_path, schema = run_silver_stream(spark, sf_dir)
    out = scratch_path(spark, "mgold-out")
    fact = T.financial_fact_stream_shape(J.read_stream(spark, silver_path, schema))
    J.append_stream(fact, out, scratch_path(spark, "mgold-chk"))
    f = J.read_output(spark, out, fact.schema)
    return _prices_double(f).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def run_posts_stream(spark, sf_dir, slice_of=None):
    """Enriched bronze posts (with re-sent copies) arriving in slices -> silver
    posts. Returns (path, schema, path of the counts)."""
    src, out = scratch_path(spark, "posts-in"), scratch_path(spark, "psilver-out")
    chk, counts = scratch_path(spark, "psilver-chk"), scratch_path(spark, "psilver-counts")
    e = enriched_posts(spark, sf_dir)
    bronze = e.unionByName(e.filter(F.col("id").cast("long") % 7 == 0))
    if slice_of is None:
        bronze = P.parse_created(bronze, out="_t")
        slice_of = J.time_slice(bronze, "_t", N_SLICES)

    def once():
        stream = J.read_stream(spark, src, bronze.schema)
        J.score_posts_stream(spark, stream.drop("_t"), out, chk, counts)

    J.feed_in_order(bronze, src, slice_of, N_SLICES, once)
    return out, spark.read.parquet(out).schema, counts


@register("stream_posts_silver", SOCIAL + SILVER_SELECT)
def q_stream_posts_silver(spark, sf_dir):
    """Silver posts from a stream with duplicate deliveries."""
    out, schema, _ = run_posts_stream(spark, sf_dir)
    return silver_out(J.read_output(spark, out, schema))


@register("stream_posts_unordered", SOCIAL + SILVER_SELECT)
def q_stream_posts_unordered(spark, sf_dir):
    """The same with posts arriving in no order of time, copies days apart."""
    out, schema, _ = run_posts_stream(spark, sf_dir, F.pmod(F.xxhash64("id", "score"), F.lit(N_SLICES)).cast("int"))
    return silver_out(J.read_output(spark, out, schema))


@register("stream_sentiment_fact", SOCIAL.rstrip() + ",\nsv as (" + SILVER_SELECT + ")\nselect "
          + ", ".join(T.SENTIMENT_FACT_STREAM_COLUMNS) + " from sv")
def q_stream_sentiment_fact(spark, sf_dir):
    """Gold: the post silver stream projected to the ten fact columns."""
    silver_path, schema, _ = run_posts_stream(spark, sf_dir)
    out = scratch_path(spark, "pgold-out")
    fact = T.sentiment_fact_stream_shape(J.read_stream(spark, silver_path, schema))
    J.append_stream(fact, out, scratch_path(spark, "pgold-chk"))
    return silver_out(J.read_output(spark, out, fact.schema))


def run_insert_stream(spark, sf_dir):
    """Ticks with duplicate deliveries inserted by key into a table partitioned
    by day, in slices, then all again from a fresh checkpoint. Returns (table
    path, counts paths of both runs, schema)."""
    src, target = scratch_path(spark, "dup-in"), scratch_path(spark, "ticks-target")
    dup = X.ticks_dup(spark, sf_dir).withColumn("datetime", F.col("datetime").cast("timestamp"))
    dup = dup.withColumn("day", F.to_date("datetime"))
    key, arrival = ["ticker", "datetime", "tie_key"], ["arrival"]
    counts = [scratch_path(spark, f"ins-counts{k}") for k in range(2)]
    chk = scratch_path(spark, "ins-chk")

    def once(chk=chk, counted=counts[0]):
        J.insert_new_stream(spark, J.read_stream(spark, src, dup.schema), target, chk, key, arrival,
                            range_col="datetime", partition_by=["day"], counts=counted, topic="market")

    J.feed_in_order(dup, src, J.time_slice(dup, "datetime", N_SLICES), N_SLICES, once)
    once(scratch_path(spark, "ins-chk-again"), counts[1])
    return target, counts, dup.schema


@register("stream_insert_new", O.with_(O.TICKS)
          + "select ticker, datetime, tie_key, price::double as price, volume from ticks")
def q_stream_insert_new(spark, sf_dir):
    """Idempotent streaming insert: the second run replays everything and adds
    nothing."""
    target, _, schema = run_insert_stream(spark, sf_dir)
    t = spark.read.schema(schema).parquet(target)
    return t.select("ticker", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "tie_key",
                    F.col("price").cast("double").alias("price"), "volume")


@register("stream_insert_counts", O.with_(O.TICKS, O.TICKS_DUP)
          + "select 'first' as run, 'market' as topic, (select count(*) from ticks_dup) as consumed, "
          "(select count(*) from ticks) as inserted, 0::bigint as errors union all "
          "select 'again', 'market', (select count(*) from ticks_dup), 0, 0")
def q_stream_insert_counts(spark, sf_dir):
    """What the batches of both runs consumed and inserted, added up."""
    _, counts, _ = run_insert_stream(spark, sf_dir)
    parts = [spark.read.parquet(c).groupBy("topic").agg(
        *[F.sum(k).alias(k) for k in ("consumed", "inserted", "errors")]).withColumn("run", F.lit(name))
        for name, c in zip(("first", "again"), counts)]
    return parts[0].unionByName(parts[1]).select("run", "topic", "consumed", "inserted", "errors")


@register("stream_bars_5min", O.with_(O.TICKS, O.bars_cte("bars_5m", "5 minutes"))
          + _BARS_OUT.replace("bars_1h", "bars_5m"))
def q_stream_bars_5min(spark, sf_dir):
    """The reference's 5-minute streaming buckets (full OHLCV), closed ones."""
    out, schema = run_bars_stream(spark, sf_dir, every="5 minutes")
    b = J.read_output(spark, out, schema)
    return _prices_double(b).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))



@register("stream_route_by_topic", ROUTE_SQL)
def q_stream_route_by_topic(spark, sf_dir):
    """Topic messages as a stream, routed to one table per topic inside
    ``foreachBatch``; the union of both targets."""
    src, chk = scratch_path(spark, "msg-in"), scratch_path(spark, "route-chk")
    targets = {"market": scratch_path(spark, "route-market"), "posts": scratch_path(spark, "route-posts")}
    msgs = X.messages(spark, sf_dir).withColumn("timestamp", F.current_timestamp())
    msgs.write.parquet(src)
    schemas = {"market": MARKET_MSG, "posts": POST_MSG}
    J.route_stream(spark, J.read_stream(spark, src, msgs.schema), schemas, targets, chk,
                   scratch_path(spark, "route-rejected"))
    parts = [J.read_output(spark, targets[t], schemas[t]).withColumn("topic", F.lit(t)) for t in schemas]
    return G.union_sources(parts).select("topic", "ticker", "price", "volume", "id", "subreddit", "score")


@register("stream_topic_counts", O.with_(O.TICKS, O.POSTS, MESSAGES_SQL)
          + "select topic, count(*) as consumed, "
          "count(distinct case when json_valid(value) then coalesce(json_extract_string(value, '$.id'), "
          "json_extract_string(value, '$.ticker') || '|' || json_extract_string(value, '$.volume')) end) as inserted, "
          "count(*) filter (where not coalesce(json_valid(value), false) or value = '{}') as errors "
          "from messages where topic in ('market', 'posts') group by topic")
def q_stream_topic_counts(spark, sf_dir):
    """Consumed, inserted and failed messages per topic of a stream that is
    routed, parsed and inserted by each topic's key."""
    src, chk = scratch_path(spark, "msg-in"), scratch_path(spark, "topic-chk")
    schemas = {"market": MARKET_MSG, "posts": POST_MSG}
    targets = {t: scratch_path(spark, f"topic-{t}") for t in schemas}
    counts = scratch_path(spark, "topic-counts")
    msgs = X.messages(spark, sf_dir)

    def once():
        J.ingest_topics(spark, J.read_stream(spark, src, msgs.schema), schemas,
                        {"market": ["ticker", "volume"], "posts": ["id"]}, targets,
                        scratch_path(spark, "topic-rejected"), counts, chk)

    J.feed_in_order(msgs, src, F.pmod(F.xxhash64("value"), F.lit(N_SLICES)).cast("int"), N_SLICES, once)
    return spark.read.parquet(counts).groupBy("topic").agg(
        *[F.sum(k).alias(k) for k in ("consumed", "inserted", "errors")])


# --- unique inserts by a key index ---------------------------------------------------

def run_indexed_insert(spark, sf_dir, bucket_keys: int = 2000):
    """Ticks with duplicate deliveries inserted into an indexed table, in slices,
    then all again from a fresh checkpoint. Returns (table, figures by batch)."""
    src = scratch_path(spark, "idx-in")
    dup = X.ticks_dup_null(spark, sf_dir).withColumn("datetime", F.col("datetime").cast("timestamp"))
    table = K.IndexedTable(spark, scratch_path(spark, "idx-table"), ["ticker", "datetime", "tie_key"], bucket_keys)
    chk, counts = scratch_path(spark, "idx-chk"), []

    def once(chk=chk):
        K.insert_indexed_stream(spark, J.read_stream(spark, src, dup.schema), table, chk, ["arrival"], counts)

    J.feed_in_order(dup, src, J.time_slice(dup, "datetime", N_SLICES), N_SLICES, once)
    once(scratch_path(spark, "idx-chk-again"))
    return table, counts


@register("stream_insert_indexed", O.with_(O.TICKS, O.TICKS_DUP, O.TICKS_DUP_NULL)
          + "select ticker, datetime, tie_key, price::double as price, volume from ticks_dup_null qualify row_number() "
          "over (partition by ticker, datetime, tie_key order by arrival nulls last) = 1")
def q_stream_insert_indexed(spark, sf_dir):
    """Streaming insert of unique keys that reads only the index buckets of a
    batch's own keys."""
    table, _ = run_indexed_insert(spark, sf_dir)
    return table.read().select("ticker", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "tie_key",
                               F.col("price").cast("double").alias("price"), "volume")


# --- late ticks -------------------------------------------------------------------------

def run_late_bars(spark, sf_dir):
    """Ticks in time order, but every 10th in the last slice and every 15th
    without a time. Returns the store of bars and the ticks."""
    src = scratch_path(spark, "late-in")
    ticks = _ticks_ts(spark, sf_dir).withColumn("datetime", F.when(F.col("tie_key") % 15 != 4, F.col("datetime")))
    store = L.BarStore(spark, scratch_path(spark, "late-bars"))
    chk = scratch_path(spark, "late-chk")
    slice_of = F.when(F.col("tie_key") % 10 == 3, N_SLICES - 1).otherwise(J.time_slice(ticks, "datetime", N_SLICES))
    J.feed_in_order(ticks, src, slice_of, N_SLICES, lambda: L.bars_with_late_ticks(
        spark, J.read_stream(spark, src, ticks.schema), store, chk))
    return store, ticks


_TIMED = "timed as (select * from ticks where tie_key % 15 <> 4)"


@register("stream_bars_late", O.with_(O.TICKS, _TIMED, O.bars_cte(source="timed"))
          + "select ticker, datetime, open::double as open, high::double as high, low::double as low, "
          "close::double as close, volume from bars_1h "
          "where datetime <= (select max(datetime) from timed) - interval 15 minute")
def q_stream_bars_late(spark, sf_dir):
    """Closed bars that late ticks have corrected: those of all ticks with a time."""
    store, _ = run_late_bars(spark, sf_dir)
    bars = store.closed().select("ticker", "datetime", "open", "high", "low", "close", "volume")
    return _prices_double(bars).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


# --- freshness --------------------------------------------------------------------------

#: One stream for each of two event types, one that falls silent half way, one without rows.
_SILENT = "select min(ts) + (max(ts) - min(ts)) / 2 from events"


def run_freshness(spark, sf_dir):
    """Updates of the sources' freshness, and the time as of which they hold."""
    src, out, chk = (scratch_path(spark, f"fresh-{k}") for k in ("in", "out", "chk"))
    t = _ticks_ts(spark, sf_dir)
    ends = t.agg(F.min("datetime"), F.max("datetime")).first()
    half = ends[0] + (ends[1] - ends[0]) / 2
    beat = t.select(F.concat(F.lit("market-"), "ticker").alias("stream"), "datetime")
    posts = t.filter(F.col("datetime") <= F.lit(half)).select(F.lit("posts").alias("stream"), "datetime")
    names = t.agg(F.lit("authors").alias("stream"), F.lit(None).cast("timestamp").alias("datetime"), F.count("*")).select(
        "stream", "datetime")
    rows = beat.unionByName(posts).unionByName(names)

    def once():
        updates = W.freshness_stream(J.read_stream(spark, src, rows.schema))
        W.follow_freshness(spark, updates, out, chk)

    J.feed_in_order(rows, src, J.time_slice(rows, "datetime", N_SLICES), N_SLICES, once)
    return spark.read.schema("stream string, latest timestamp, status string, n long").parquet(out), ends[1]


@register("stream_freshness", f"""
with beat as (select 'market-' || event_type as stream, ts from events
              union all select 'posts', ts from events where ts <= ({_SILENT})
              union all select 'authors', null),
last_ as (select stream, max(ts) as latest from beat group by 1),
age as (select stream, latest, epoch_us((select max(ts) from events)) - epoch_us(latest) as us from last_)
select stream, round(us / 60e6, 3) as age_minutes,
       case when latest is null then 'NO DATA' when us < 600e6 then 'OK' else 'STALE' end as status from age""")
def q_stream_freshness(spark, sf_dir):
    """Status of each source at the end; the silent one turned STALE by a timer."""
    updates, as_of = run_freshness(spark, sf_dir)
    return W.current(updates, as_of)
