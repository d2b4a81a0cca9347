"""Bronze/ingest and market-star queries: normalise, de-duplicate, insert-new,
unique-key check, union, routing, JSON, snapshot documents, dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField,
                               StructType)

from marketpulse.operators import bars as B
from marketpulse.operators import indicators as I
from marketpulse.operators import ingest as G
from marketpulse.operators import star as T
from marketpulse.plans import oracle as O
from marketpulse.plans.catalog import register
from marketpulse.plans.market import as_double, bars_1h
from marketpulse.session import scratch_path
from marketpulse.sources import fixtures as X
from marketpulse.sources import topics
from marketpulse.sources.sinks import new_rows, write_table

TICK_KEY = ["ticker", "datetime", "tie_key"]


# --- star, market half ---------------------------------------------------------

def market_fact(spark, sf_dir) -> DataFrame:
    return I.with_indicators(bars_1h(spark, sf_dir), ["ticker"], ["datetime"], strategy="partition")


@register("ticker_dim", O.with_(O.TICKS) + "select distinct ticker from ticks")
def q_ticker_dim(spark, sf_dir):
    return T.ticker_dim(bars_1h(spark, sf_dir))


_TIME_PARTS = ("year(datetime) as year, month(datetime) as month, day(datetime) as day, "
               "weekofyear(datetime) as week, quarter(datetime) as quarter, hour(datetime) as hour, "
               "minute(datetime) as minute, second(datetime) as second")


@register("time_dim", O.with_(O.TICKS, O.BARS_1H)
          + f"select datetime, {_TIME_PARTS} from (select distinct datetime from bars_1h)")
def q_time_dim(spark, sf_dir):
    return T.time_dim(bars_1h(spark, sf_dir))


@register("financial_fact_stream_shape", O.with_(O.TICKS, O.BARS_1H)
          + "select ticker, datetime, open::double as open, close::double as close, high::double as high, "
          "low::double as low, volume, ((close - lag(close) over w)::double / nullif((lag(close) over w)::double, 0)) * 100 as PrctChange, "
          "case when close > lag(close) over w then 'Up' when close < lag(close) over w then 'Down' else 'No Change' end as Direction "
          "from bars_1h window w as (partition by ticker order by datetime)")
def q_financial_fact_stream_shape(spark, sf_dir):
    silver = I.add_pct_change(bars_1h(spark, sf_dir), ["ticker"], ["datetime"])
    return as_double(T.financial_fact_stream_shape(silver))


@register("star_market_rollup", O.with_(O.TICKS, O.BARS_1H)
          + "select ticker, year(datetime) as year, quarter(datetime) as quarter, count(*) as n_bars, "
          "sum(close)::double / count(close) as avg_close, max(high)::double as max_high, "
          "min(low)::double as min_low, sum(volume)::bigint as total_volume from bars_1h group by all")
def q_star_market_rollup(spark, sf_dir):
    """Fact joined to the time dimension, rolled up by ticker/year/quarter."""
    fact = market_fact(spark, sf_dir)
    return T.market_rollup(fact, T.time_dim(fact))


_CYCLE = 7


@register("latest_bar", O.with_(O.TICKS, O.BARS_1H)
          + "select ticker, strftime(datetime, '%Y-%m-%d %H:%M:%S') as datetime, "
          "strftime(datetime, '%Y-%m-%dT%H:%M:%S') as timestamp, open::double as open, high::double as high, "
          "low::double as low, close::double as close, volume, strftime((select max(datetime) from ticks), "
          f"'%Y-%m-%dT%H:%M:%S') as scraped_at, 'events' as data_source, {_CYCLE} as cycle, 60 as interval_minutes "
          "from bars_1h qualify row_number() over (partition by ticker order by datetime desc) = 1")
def q_latest_bar(spark, sf_dir):
    """The latest bar of each ticker as a message: times as texts, prices, and
    when, from where and in which cycle it was taken."""
    bars = as_double(bars_1h(spark, sf_dir))
    latest = T.latest_per_key(bars, "ticker", ["datetime"], [c for c in bars.columns if c != "ticker"])
    now = X.ticks(spark, sf_dir).select(F.max("datetime")).scalar()
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    out = latest.select("ticker", F.date_format("datetime", G.BAR_TIME_FORMAT).alias("datetime"),
                        F.date_format("datetime", iso).alias("timestamp"),
                        "open", "high", "low", "close", "volume", F.date_format(now, iso).alias("scraped_at"))
    return G.with_metadata(out, {"data_source": "events", "cycle": _CYCLE, "interval_minutes": 60})


@register("series_span", O.with_(O.TICKS)
          + "select ticker, min(datetime) as first_datetime, max(datetime) as last_datetime, "
          "count(*) as n_records from ticks group by ticker")
def q_series_span(spark, sf_dir):
    return X.ticks(spark, sf_dir).groupBy("ticker").agg(
        F.min("datetime").alias("first_datetime"), F.max("datetime").alias("last_datetime"),
        F.count(F.lit(1)).alias("n_records"))


# --- de-duplication and idempotent inserts ------------------------------------

_TICK_OUT = "ticker, datetime, tie_key, price::double as price, volume"


@register("dedup_keep_first", O.with_(O.TICKS, O.TICKS_DUP, O.TICKS_DUP_NULL)
          + f"select {_TICK_OUT} from ticks_dup_null qualify row_number() over "
          "(partition by ticker, datetime, tie_key order by arrival nulls last) = 1")
def q_dedup_keep_first(spark, sf_dir):
    """First arrival per key wins, result sorted by time."""
    d = G.keep_first(X.ticks_dup_null(spark, sf_dir), TICK_KEY, ["arrival"])
    return (d.select("ticker", "datetime", "tie_key", F.col("price").cast("double").alias("price"),
                     "volume").orderBy("datetime", "tie_key"))


@register("insert_new_bars", O.with_(O.TICKS, O.TICKS_DUP, O.TICKS_DUP_NULL, O.STORED_TICKS)
          + f"select {_TICK_OUT} from (select * from ticks_dup_null qualify row_number() over "
          "(partition by ticker, datetime, tie_key order by arrival nulls last) = 1) n "
          "where not exists (select 1 from stored_ticks s where s.ticker = n.ticker "
          "and s.datetime = n.datetime and s.tie_key = n.tie_key)")
def q_insert_new_bars(spark, sf_dir):
    """Rows an insert-new load would append (stored side pruned to the
    incoming time range)."""
    rows = new_rows(X.ticks_dup_null(spark, sf_dir), X.stored_ticks(spark, sf_dir), TICK_KEY,
                    ["arrival"], range_col="datetime")
    return rows.select("ticker", "datetime", "tie_key",
                       F.col("price").cast("double").alias("price"), "volume")


@register("dup_key_check", O.with_(O.TICKS_WIDE)
          + "select ticker, datetime, count(*) as n_rows from ticks_wide group by all having count(*) > 1")
def q_dup_key_check(spark, sf_dir):
    """(ticker, datetime) is not a unique key of the wide ticks: the offenders."""
    return G.duplicate_keys(X.ticks_wide(spark, sf_dir), ["ticker", "datetime"])


@register("union_sources", O.with_(O.TICKS)
          + "select ticker, datetime, price::double as price, volume, null::varchar as source "
          "from ticks where datetime < timestamp '2024-01-15' union all by name "
          "select ticker, datetime, price::double as price, 'late' as source from ticks "
          "where datetime >= timestamp '2024-01-15'")
def q_union_sources(spark, sf_dir):
    """Two chunks with different columns concatenated by name."""
    t = X.ticks(spark, sf_dir).withColumn("price", F.col("price").cast("double"))
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    a = t.filter(F.col("datetime") < cut).select("ticker", "datetime", "price", "volume")
    b = (t.filter(F.col("datetime") >= cut).select("ticker", "datetime", "price")
         .withColumn("source", F.lit("late")))
    return G.union_sources([a, b])


# --- vendor frame normalisation, formats --------------------------------------

def vendor_frame(spark, sf_dir) -> DataFrame:
    """A raw vendor price frame (unrounded prices, fractional volume)."""
    li = X.read_table(spark, sf_dir, "lineitem")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_shipdate").alias("Date"),
        unit.alias("Open"),
        (unit * (F.lit(1.0) + F.col("l_tax"))).alias("High"),
        (unit * (F.lit(1.0) - F.col("l_discount"))).alias("Low"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) / F.col("l_quantity")).alias("Close"),
        (F.col("l_quantity") * F.lit(1000.5)).alias("Volume"),
        F.lit(0.0).alias("Dividends"), F.lit(0.0).alias("Stock Splits"))


def _r2(x: str) -> str:
    return f"round(({x})::varchar::decimal(38,20), 2)::double"


@register("ohlcv_normalise",
          "with v as (select l_orderkey, l_linenumber, l_partkey, l_shipdate, "
          "l_extendedprice / l_quantity as u, l_tax, l_discount, l_extendedprice, l_quantity from lineitem) "
          "select l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as datetime, "
          f"{_r2('u')} as open, {_r2('u * (1.0::double + l_tax)')} as high, "
          f"{_r2('u * (1.0::double - l_discount)')} as low, "
          f"{_r2('l_extendedprice * (1.0::double - l_discount) / l_quantity')} as close, "
          "trunc(l_quantity * 1000.5::double)::bigint as volume from v")
def q_ohlcv_normalise(spark, sf_dir):
    return G.normalise_ohlcv(vendor_frame(spark, sf_dir))


@register("ts_format", O.with_(O.TICKS)
          + "select tie_key, strftime(datetime, '%Y-%m-%d %H:%M:%S') as datetime_text, "
          "strftime(datetime, '%Y-%m-%d') as date_text, "
          "case when microsecond(datetime) % 1000000 = 0 then strftime(datetime, '%Y-%m-%dT%H:%M:%S') "
          "else strftime(datetime, '%Y-%m-%dT%H:%M:%S.%f') end as iso_text from ticks")
def q_ts_format(spark, sf_dir):
    """Timestamp -> fixed texts: bar time, day, ISO-8601 (fraction only if any)."""
    t = X.ticks(spark, sf_dir)
    dt = F.col("datetime")
    frac = F.unix_micros(dt.cast("timestamp")) % 1000000
    iso = F.when(frac == 0, F.date_format(dt, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(dt, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return t.select("tie_key", F.date_format(dt, G.BAR_TIME_FORMAT).alias("datetime_text"),
                    F.date_format(dt, G.DAY_FORMAT).alias("date_text"), iso.alias("iso_text"))


_BAR_JSON = ("to_json({'datetime': strftime(datetime, '%Y-%m-%d %H:%M:%S'), 'open': open::double, "
             "'high': high::double, 'low': low::double, 'close': close::double, 'volume': volume})")


@register("to_kafka_value", O.with_(O.TICKS, O.BARS_1H)
          + f"select ticker as key, {_BAR_JSON} as value, 'market-data' as topic from bars_1h")
def q_to_kafka_value(spark, sf_dir):
    """Bars as broker messages: key, JSON value, topic."""
    b = as_double(bars_1h(spark, sf_dir)).withColumn(
        "datetime", F.date_format("datetime", G.BAR_TIME_FORMAT))
    return G.to_message(b, "ticker", "market-data",
                        ["datetime", "open", "high", "low", "close", "volume"])


#: Bytes of the largest message of ``publish_outcomes``.
SMALL_MESSAGE = 42


@register("publish_outcomes", O.with_(O.POSTS)
          + ", m as (select case when id::bigint % 11 <> 0 then id end as key, case when id::bigint % 13 <> 0 then "
          "to_json({'id': id, 'subreddit': subreddit, 'score': coalesce(score, 0)}) end as value from posts), "
          "r as (select case when key is null then 'no key' when value is null then 'not encoded' "
          f"when octet_length(encode(value)) + octet_length(encode(key)) > {SMALL_MESSAGE} then 'too large' else 'sent' end as outcome from m) "
          "select outcome, count(r.outcome) as n from (values ('sent'), ('no key'), ('not encoded'), ('too large')) o(outcome) "
          "left join r using (outcome) group by 1")
def q_publish_outcomes(spark, sf_dir):
    """Posts published as messages: sent, and rejected by reason, as the writes
    observed them; both tables hold what was counted."""
    there = F.col("id").cast("long") % 13 != 0
    p = X.posts(spark, sf_dir).withColumn("key", F.when(F.col("id").cast("long") % 11 != 0, F.col("id")))
    p = p.select("key", F.when(there, F.col("id")).alias("id"), F.when(there, F.col("subreddit")).alias("subreddit"),
                 F.when(there, F.coalesce("score", F.lit(0))).alias("score"))
    sent, dead = scratch_path(spark, "published"), scratch_path(spark, "dead-letters")
    told = topics.publish_batch(p, dead, "key", "posts", ["id", "subreddit", "score"], "parquet", {"path": sent}, SMALL_MESSAGE)
    stored = spark.read.parquet(sent).select(F.lit("sent").alias("outcome")).unionByName(
        spark.read.parquet(dead).select(F.col("reason").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("stored"))
    said = spark.createDataFrame(list(told.items()), "outcome string, n long")
    met = said.join(stored, "outcome", "left").withColumn("stored", F.coalesce("stored", F.lit(0)))
    return met.select("outcome", F.when(F.col("n") == F.col("stored"), F.col("n")).alias("n"))


# --- routing and JSON -------------------------------------------------------------

MARKET_MSG = StructType([StructField("ticker", StringType()), StructField("price", DoubleType()),
                         StructField("volume", LongType())])
POST_MSG = StructType([StructField("id", StringType()), StructField("subreddit", StringType()),
                       StructField("score", LongType())])

# every 97th market message is broken in one of four ways, and some have no topic
MESSAGES_SQL = """messages as (
  select case when tie_key % 97 = 9 then 'other' else 'market' end as topic,
         case tie_key % 97 when 5 then 'not json' when 6 then '{"ticker": "' when 7 then null when 8 then '{}'
              else to_json({'ticker': ticker, 'price': price::double, 'volume': volume})::varchar end as value from ticks
  union all
  select 'posts', to_json({'id': id, 'subreddit': subreddit, 'score': score})::varchar from posts)"""


ROUTE_SQL = (O.with_(O.TICKS, O.POSTS, MESSAGES_SQL)
             + "select topic, json_extract_string(value, '$.ticker') as ticker, "
          "json_extract(value, '$.price')::double as price, json_extract(value, '$.volume')::bigint as volume, "
          "null::varchar as id, null::varchar as subreddit, null::bigint as score from messages where topic = 'market' and json_valid(value) "
          "union all select topic, null, null, null, json_extract_string(value, '$.id'), "
          "json_extract_string(value, '$.subreddit'), json_extract(value, '$.score')::bigint "
          "from messages where topic = 'posts'")


@register("route_by_topic", ROUTE_SQL)
def q_route_by_topic(spark, sf_dir):
    """Each message parsed by its topic's schema, both targets in one frame."""
    routed = G.route(X.messages(spark, sf_dir), {"market": MARKET_MSG, "posts": POST_MSG})
    parts = [df.filter(~F.col("_bad")).drop("_bad").withColumn("topic", F.lit(t))
             for t, df in routed.items()]
    return G.union_sources(parts).select("topic", "ticker", "price", "volume", "id",
                                         "subreddit", "score")


_SCHEMAS = {"market": MARKET_MSG, "posts": POST_MSG}


@register("route_rejects", O.with_(O.TICKS, O.POSTS, MESSAGES_SQL)
          + "select topic, value from messages where value is null or not json_valid(value) "
          "or topic not in ('market', 'posts')")
def q_route_rejects(spark, sf_dir):
    """The messages that no route takes."""
    return G.rejects(X.messages(spark, sf_dir), _SCHEMAS)


@register("ingest_counters", O.with_(O.TICKS, O.POSTS, MESSAGES_SQL)
          + "select topic, count(*) as consumed, count(*) filter (where json_valid(value)) as parsed, "
          "count(*) filter (where not json_valid(value) or value is null) as errors from messages group by topic")
def q_ingest_counters(spark, sf_dir):
    """Consumed / parsed / error counts per topic in one aggregate."""
    m = G.parse_messages(X.messages(spark, sf_dir), StructType([]))
    return m.groupBy("topic").agg(F.count(F.lit(1)).alias("consumed"),
                                  F.count_if(~F.col("_bad")).alias("parsed"),
                                  F.count_if("_bad").alias("errors"))


@register("json_roundtrip", O.with_(O.TICKS)
          + "select ticker, strftime(datetime, '%Y-%m-%d %H:%M:%S') as datetime, price::double as price, volume from ticks")
def q_json_roundtrip(spark, sf_dir):
    """Encode ticks as JSON messages and decode them again."""
    t = X.ticks(spark, sf_dir).select(
        "ticker", F.date_format("datetime", G.BAR_TIME_FORMAT).alias("datetime"),
        F.col("price").cast("double").alias("price"), "volume")
    schema = StructType([StructField("ticker", StringType()), StructField("datetime", StringType()),
                         StructField("price", DoubleType()), StructField("volume", LongType())])
    enc = G.to_message(t, None)
    return enc.select(F.from_json("value", schema).alias("m")).select("m.*")


# --- nested snapshot documents ---------------------------------------------------

DAY_BAR = StructType([StructField(c, t) for c, t in [
    ("date", StringType()), ("open", DoubleType()), ("high", DoubleType()), ("low", DoubleType()),
    ("close", DoubleType()), ("volume", LongType())]])
QUOTE = StructType([StructField(c, t) for c, t in [
    ("symbol", StringType()), ("price", DoubleType()), ("previous_close", DoubleType()),
    ("open", DoubleType()), ("day_high", DoubleType()), ("day_low", DoubleType()),
    ("volume", LongType()), ("market_cap", DoubleType()), ("52_week_high", DoubleType()),
    ("52_week_low", DoubleType())]])
SNAPSHOT = StructType([StructField("scraped_at", StringType()), StructField("ticker", StringType()),
                       StructField("current", QUOTE), StructField("history", ArrayType(DAY_BAR))])


def daily_bars(spark, sf_dir) -> DataFrame:
    d = as_double(B.ohlcv_bars(X.ticks(spark, sf_dir), "1 day", label="start"))
    return d.withColumn("date", F.date_format("datetime", G.DAY_FORMAT)).drop("datetime")


def write_snapshots(spark, sf_dir, path: str) -> None:
    """One snapshot document per ticker and month: the month's daily bars as
    ``history`` (at most 31 entries, so the nesting group is bounded) and the
    last day as ``current``."""
    d = daily_bars(spark, sf_dir)
    bar = F.struct(*[F.col(c) for c in DAY_BAR.fieldNames()])
    docs = d.groupBy("ticker", F.substring("date", 1, 7).alias("month")).agg(
        F.sort_array(F.collect_list(bar)).alias("history"))
    last = F.element_at("history", -1)
    docs = docs.select(
        F.concat(F.col("month"), F.lit("-28T00:00:00")).alias("scraped_at"), "ticker",
        F.struct(F.col("ticker").alias("symbol"), last["close"].alias("price"),
                 F.when(F.size("history") > 1, F.element_at("history", -2)["close"]).alias("previous_close"),
                 last["open"].alias("open"), last["high"].alias("day_high"),
                 last["low"].alias("day_low"), last["volume"].alias("volume"),
                 (last["close"] * last["volume"]).alias("market_cap"),
                 F.array_max(F.transform("history", lambda h: h["high"])).alias("52_week_high"),
                 F.array_min(F.transform("history", lambda h: h["low"])).alias("52_week_low")).alias("current"),
        "history")
    docs.write.mode("overwrite").json(path)


def explode_history(docs: DataFrame) -> DataFrame:
    return docs.select("ticker", F.explode("history").alias("h")).select("ticker", "h.*")


def quote(docs: DataFrame) -> DataFrame:
    return docs.select("ticker", "scraped_at", "current.*")


_DAILY = O.bars_cte("bars_1d", "1 day").replace(
    "time_bucket(interval '1 day', datetime) + interval '1 day'", "time_bucket(interval '1 day', datetime)")


@register("snapshot_explode", O.with_(O.TICKS, _DAILY)
          + "select ticker, strftime(datetime, '%Y-%m-%d') as date, open::double as open, high::double as high, "
          "low::double as low, close::double as close, volume from bars_1d")
def q_snapshot_explode(spark, sf_dir):
    """Write nested snapshot documents, read them back with a schema, explode."""
    path = scratch_path(spark, "snapshots")
    write_snapshots(spark, sf_dir, path)
    docs = spark.read.schema(SNAPSHOT).json(path)
    return explode_history(docs)


@register("roundtrip_write", O.with_(O.TICKS, O.BARS_1H)
          + "select ticker, datetime, open::double as open, high::double as high, low::double as low, "
          "close::double as close, volume, strftime(datetime, '%Y-%m-%d') as day from bars_1h")
def q_roundtrip_write(spark, sf_dir):
    """Overwrite a date-partitioned Parquet table and read it back."""
    path = scratch_path(spark, "bars")
    b = as_double(bars_1h(spark, sf_dir)).withColumn("day", F.date_format("datetime", G.DAY_FORMAT))
    write_table(b, path, partition_by=["day"])
    schema = b.schema
    return spark.read.schema(schema).parquet(path)


@register("snapshot_quote", O.with_(O.TICKS, _DAILY)
          + ", d as (select ticker, strftime(datetime, '%Y-%m') as month, strftime(datetime, '%Y-%m-%d') as date, "
          "open, high, low, close, volume from bars_1d) "
          "select ticker, month || '-28T00:00:00' as scraped_at, ticker as symbol, "
          "arg_max(close, date)::double as price, arg_max(open, date)::double as open, "
          "arg_max(high, date)::double as day_high, arg_max(low, date)::double as day_low, "
          "arg_max(volume, date) as volume, arg_max(close, date, 2)[2]::double as previous_close, "
          "arg_max(close, date)::double * arg_max(volume, date) as market_cap, "
          "max(high)::double as \"52_week_high\", min(low)::double as \"52_week_low\" from d group by ticker, month")
def q_snapshot_quote(spark, sf_dir):
    """The ``current`` quote block of each snapshot document, flattened: ten
    fields. The year's range is that of the document's history, and the market
    value price times volume, for want of either in the tables."""
    path = scratch_path(spark, "snapshots")
    write_snapshots(spark, sf_dir, path)
    return quote(spark.read.schema(SNAPSHOT).json(path))


@register("bars_5min_last_close", O.with_(O.TICKS)
          + "select ticker, time_bucket(interval '5 minutes', datetime) + interval '5 minutes' as datetime, "
          "arg_max(price, (datetime, tie_key))::double as close from ticks group by 1, 2")
def q_bars_5min_last_close(spark, sf_dir):
    """The reference's streaming bucket: last price per ticker and 5 minutes."""
    b = B.last_close_bars(X.ticks(spark, sf_dir), "5 minutes")
    return b.withColumn("close", F.col("close").cast("double"))


@register("ohlcv_normalise_daily",
          "with v as (select l_orderkey, l_linenumber, l_partkey, l_shipdate, "
          "l_extendedprice / l_quantity as u, l_quantity from lineitem) "
          "select l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') as date, "
          f"{_r2('u')} as open, trunc(l_quantity * 1000.5::double)::bigint as volume from v")
def q_ohlcv_normalise_daily(spark, sf_dir):
    """The date-only form of the normalised vendor frame."""
    d = G.normalise_ohlcv(vendor_frame(spark, sf_dir), date_only=True)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "date", "open", "volume")
